import random
from datetime import date, timedelta

import pytest

from entity360.plans.company_mart import company_mart, engagement_lists, engagement_totals
from entity360.plans.membership import membership_status
from entity360.sources.schemas import COMPANY_MART_SCHEMA, DIM_COMPANY_SCHEMA, LEDGER_SCHEMA
from tests.fixtures import AS_OF, JUNE, MAY, bridge, collect, frame
from tests.test_membership import month, months


def event(number, company="A", kind="deal", start=None, **more):
    row = {
        "engagement_event_id": f"e{number:03d}",
        "canonical_company_id": company,
        "source_system": "hubspot",
        "engagement_category": "Business",
        "engagement_type": kind,
        "engagement_name": f"n{number}",
        "start_date": start,
        "partner_company_ids": [],
        "partner_names": [],
        "requires_manual_review": False,
    }
    return {**row, **more}


DAY = date(2024, 1, 1)
EVENTS = (
    [event(i, start=DAY + timedelta(days=i)) for i in range(30)]
    + [event(100 + i, kind="project", start=DAY + timedelta(days=i), source_system="bigtime") for i in range(12)]
    + [event(200, kind="membership", start=None, source_system="officernd", amount=5.0)]
    + [event(300, company="B", amount=2.5, end_date=date(2030, 1, 1), requires_manual_review=True, match_confidence=0.3)]
    + [event(301, company=None, amount=99.0)]
)


def ledger(spark, rows=EVENTS, seed=0):
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    return frame(spark, None, shuffled, LEDGER_SCHEMA)


def test_lists_order_limits_and_ties(spark):
    rows = {r["canonical_company_id"]: r for r in collect(engagement_lists(ledger(spark)))}
    assert set(rows) == {"A", "B"}
    names = [x["engagement_name"] for x in rows["A"]["engagement_timeline"]]
    expected = [f"n{i}" for i in range(29, 11, -1)] + ["n11", "n111"]
    assert names == expected
    assert [x["engagement_name"] for x in rows["A"]["recent_engagements"]] == expected[:10]
    assert [x["engagement_name"] for x in rows["A"]["project_engagements"]] == [f"n{i}" for i in range(111, 101, -1)]
    assert [x["engagement_name"] for x in rows["A"]["deal_engagements"]] == [f"n{i}" for i in range(29, 19, -1)]
    assert [x["engagement_name"] for x in rows["A"]["membership_engagements"]] == ["n200"]
    assert rows["B"]["project_engagements"] == []
    assert "engagement_category" not in rows["A"]["recent_engagements"][0]


def test_lists_do_not_depend_on_input_order(spark):
    first = sorted(map(str, collect(engagement_lists(ledger(spark, seed=1)))))
    second = sorted(map(str, collect(engagement_lists(ledger(spark, seed=2).repartition(7)))))
    assert first == second


def test_totals(spark):
    rows = {r["canonical_company_id"]: r for r in collect(engagement_totals(ledger(spark)))}
    a, b = rows["A"], rows["B"]
    assert (a["total_engagement_count"], a["deal_engagement_count"], a["project_engagement_count"]) == (43, 30, 12)
    assert (a["hubspot_engagement_count"], a["bigtime_engagement_count"]) == (30, 12)
    assert a["engagement_source_systems"] == ["bigtime", "hubspot", "officernd"]
    assert a["engagement_source_system_count"] == 3
    assert (a["membership_amount"], a["deal_amount"]) == (5.0, 0.0)
    assert a["total_source_reported_engagement_amount"] == 5.0
    assert b["most_recent_engagement_date"] == date(2030, 1, 1)
    assert b["has_engagement_manual_review_mapping"] is True


@pytest.fixture(scope="module")
def mart(spark):
    dim = frame(
        spark,
        None,
        [
            {
                "canonical_company_id": c,
                "source_system_count": n,
                "hubspot_company_ids": [],
                "has_manual_review_mapping": False,
                "min_match_confidence": x,
            }
            for c, n, x in [("A", 2, 0.9), ("B", 1, None), ("C", 1, 0.6), ("Q", 1, None)]
        ],
        DIM_COMPANY_SCHEMA,
    )
    rows = [
        month(JUNE, membership_id=None, member_id=None),
        month(MAY, company="o2"),
    ]
    status = membership_status(months(spark, rows), bridge(spark), AS_OF)
    return company_mart(dim, status, ledger(spark), AS_OF)


def test_mart_schema(mart):
    assert len(mart.columns) == 81
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in COMPANY_MART_SCHEMA]


def test_mart_values(mart):
    rows = {r["canonical_company_id"]: r for r in collect(mart)}
    assert set(rows) == {"A", "B", "C", "Q"}
    a, b, c, q = (rows[k] for k in "ABCQ")
    # A row in the current month, but no membership id in it.
    assert a["has_active_membership"] is True and a["membership_status"] == "former_member"
    assert a["current_total_mrr"] == 10.0 and a["is_multi_source_company"] is True
    assert a["min_match_confidence"] == 0.8
    assert b["min_match_confidence"] == 0.3 and b["has_any_manual_review_mapping"] is True
    assert b["has_identity_manual_review_mapping"] is False
    assert c["membership_status"] == "former_member" and c["has_active_membership"] is False
    assert c["current_location_ids"] == [] and c["first_membership_month"] == MAY
    # o2 has no review flag, so its history needs a review.
    assert c["has_any_manual_review_mapping"] is True
    assert q["membership_status"] == "no_membership_record" and q["min_match_confidence"] is None
    assert q["engagement_timeline"] == [] and q["total_engagement_count"] == 0
    assert q["has_engagement"] is False and q["has_any_manual_review_mapping"] is False
    assert q["first_engagement_date"] is None and q["current_total_mrr"] == 0.0


def test_mart_is_the_same_with_its_parts_stored_before(spark):
    """Lists and totals handed in, as they are once stored, and no event read for them again."""
    from entity360.plans import company_mart as mart
    from entity360.registry import Product, flat
    from entity360.sources.sample import AS_OF

    p = Product(spark, "/root/testdata/sf0.001")
    whole = mart.company_mart(p.dim, p.status, p.ledger, AS_OF)
    assert sorted(map(repr, flat(p.mart).collect())) == sorted(map(repr, flat(whole).collect()))
    text = p.mart._jdf.queryExecution().executedPlan().toString()
    # The months of the status are read, no memberships.
    assert text.count("FileScan parquet [l_") <= 2 and "FileScan parquet [event_id" not in text
