import random

from hypothesis import given, settings
from hypothesis import strategies as st

from entity360.operators import in_period, smallest_distinct
from entity360.plans.membership import (
    current_membership,
    membership_history,
    membership_month_rows,
    membership_status,
)
from entity360.sources.schemas import MEMBERSHIP_STATUS_SCHEMA
from pyspark.sql import functions as F
from tests.fixtures import AS_OF, BRIDGE, JULY, JUNE, MAY, bridge, collect, frame, link


def month(month_start, company="o1", **more):
    row = {
        "month_start": month_start,
        "company_id": company,
        "location_id": "L1",
        "plan_id": "P1",
        "plan_name": "Plan 1",
        "member_id": "x",
        "membership_id": "m",
        "price": 10.0,
        "is_contracted_in_month": True,
    }
    return {**row, **more}


MONTHS = [
    month(JUNE, membership_status="b", discounted_price=8.0),
    month(JUNE, membership_status="a", membership_id="m2", calculated_list_price=12.0),
    month(JUNE, membership_status=None, membership_id="m2", member_id=None, price=None),
    month(JUNE, plan_id="P2", plan_name=None, calculated_discount_amount=1.5),
    month(JUNE, plan_id="P2", plan_name="Other", location_id=None),
    month(MAY, membership_category="Desk"),
    month(JULY),
    month(JUNE, is_contracted_in_month=False),
    month(JUNE, is_contracted_in_month=None),
    month(MAY, company="o2"),
    month(JUNE, company="o3"),
    month(JUNE, company="o9"),
]


def months(spark, rows=MONTHS):
    return frame(spark, "int_membership_months", rows)


def test_periods(spark):
    df = months(spark)
    assert in_period(df, "month_start", AS_OF, "current").count() == 8 + 1
    assert in_period(df, "month_start", AS_OF, "future").count() == 1
    assert in_period(df, "month_start", AS_OF, "past_current").count() == 11


def test_month_rows_drop_uncontracted_and_future(spark):
    rows = collect(membership_month_rows(months(spark), bridge(spark), AS_OF))
    assert len(rows) == 9
    assert {r["membership_category"] for r in rows} == {"Uncategorized", "Desk"}


def test_status_groups(spark):
    status = membership_status(months(spark), bridge(spark), AS_OF)
    assert status.schema.fieldNames() == MEMBERSHIP_STATUS_SCHEMA.fieldNames()
    rows = collect(status)
    assert len(rows) == 7
    main = next(r for r in rows if r["plan_id"] == "P1" and r["month_start"] == JUNE and r["canonical_company_id"])
    assert (main["active_memberships"], main["active_members"]) == (2, 1)
    assert main["total_mrr"] == 18.0
    assert main["total_calculated_list_price"] == 8.0 + 12.0
    assert main["observed_membership_statuses"] == ["a", "b"]
    assert main["has_manual_review_mapping"] is False and main["min_match_confidence"] == 0.8
    by_company = {r["officernd_company_id"]: r for r in rows}
    assert by_company["o3"]["canonical_company_id_is_null"] is True
    assert by_company["o3"]["has_manual_review_mapping"] is False
    assert by_company["o9"]["has_manual_review_mapping"] is True
    assert by_company["o2"]["has_manual_review_mapping"] is True


def test_status_future(spark):
    rows = collect(membership_status(months(spark), bridge(spark), AS_OF, "future"))
    assert [r["month_start"] for r in rows] == [JULY]


def test_status_limits_observed_states_to_ten(spark):
    rows = [month(JUNE, membership_status=f"s{i:02d}", membership_id=str(i)) for i in range(30)]
    random.Random(1).shuffle(rows)
    got = collect(membership_status(months(spark, rows), bridge(spark), AS_OF))
    assert got[0]["observed_membership_statuses"] == [f"s{i:02d}" for i in range(10)]
    assert got[0]["active_memberships"] == 30


def test_status_equals_row_level_join_with_repeated_mappings(spark):
    """Aggregating before the lookup must not hide rows that a repeated mapping multiplies."""
    links = BRIDGE + [link("officernd", "o1", "A", True, 0.2), link("officernd", "o1", "Z", False, 0.5)]
    rows = membership_month_rows(months(spark), bridge(spark, links), AS_OF)
    keys = ["month_start", "canonical_company_id", "officernd_company_id", "location_id", "plan_id", "plan_name", "membership_category"]
    expected = rows.groupBy(*keys).agg(
        F.count_distinct("membership_id").alias("active_memberships"),
        F.count_distinct("member_id").alias("active_members"),
        F.sum(F.coalesce("discounted_price", "price", F.lit(0.0))).alias("total_mrr"),
        F.bool_or("requires_manual_review").alias("has_manual_review_mapping"),
        F.min("match_confidence").alias("min_match_confidence"),
    )
    got = membership_status(months(spark), bridge(spark, links), AS_OF).select(*expected.columns)
    assert sorted(map(str, collect(got))) == sorted(map(str, collect(expected)))


def test_current_and_history(spark):
    status = membership_status(months(spark), bridge(spark), AS_OF)
    current = {r["canonical_company_id"]: r for r in collect(current_membership(status, AS_OF))}
    assert set(current) == {"A"}
    a = current["A"]
    assert a["current_plan_ids"] == ["P1", "P2"] and a["current_plan_names"] == ["Other", "Plan 1"]
    assert a["current_location_ids"] == ["L1"]
    # Members in two plans count twice.
    assert a["current_active_members"] == 3
    history = {r["canonical_company_id"]: r for r in collect(membership_history(status, AS_OF))}
    assert set(history) == {"A", "C"}
    assert history["A"]["membership_month_count"] == 2
    assert history["A"]["all_membership_categories"] == ["Desk", "Uncategorized"]
    assert history["C"]["most_recent_membership_month"] == MAY


def test_smallest_distinct_limits_and_skips_nulls(spark):
    rows = [("k", f"{i:03d}", "only") for i in range(60)] * 2 + [("k", None, None), ("n", None, None)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, a string, b string")
    got = collect(smallest_distinct(df, ["key"], {"a": F.col("a"), "b": F.col("b")}, 25))
    assert got == [{"key": "k", "a": [f"{i:03d}" for i in range(25)], "b": ["only"]}]


cents = st.integers(0, 10_000_00).map(lambda c: c / 100)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([MAY, JUNE, JULY]),
            st.sampled_from(["o1", "o2", "o3", "o9"]),
            st.sampled_from(["P1", "P2"]),
            st.none() | cents,
        ),
        min_size=1,
        max_size=25,
    )
)
def test_status_totals_equal_row_totals(spark, drawn):
    rows = [month(m, c, plan_id=p, price=x) for m, c, p, x in drawn]
    got = collect(membership_status(months(spark, rows), bridge(spark), AS_OF))
    expected = sum(round((x or 0) * 100) for m, _, _, x in drawn if m != JULY)
    assert round(sum(r["total_mrr"] for r in got) * 100) == expected


def test_counts_do_not_depend_on_how_a_group_is_made_up(spark):
    """A month alone, several that share ids, and months without ids, with NULL and many states."""
    def month(plan, membership, member, status):
        return {
            "month_start": MAY, "company_id": "o1", "location_id": None, "membership_category": None,
            "plan_id": plan, "membership_id": membership, "member_id": member,
            "membership_status": status, "price": 1.0, "is_contracted_in_month": True,
        }

    rows = [month("one", "m1", None, None), month("none", None, None, "active")]
    rows += [month("some", f"m{i % 3}", None if i % 2 else f"p{i % 4}", f"s{i:02}") for i in range(12)]
    rows += [month("some", None, "p0", None)]
    months = frame(spark, "int_membership_months", rows)
    got = {r["plan_id"]: r for r in collect(membership_status(months, bridge(spark), AS_OF))}
    counts = {p: (r["active_memberships"], r["active_members"], r["total_mrr"]) for p, r in got.items()}
    assert counts == {"one": (1, 0, 1.0), "none": (0, 0, 1.0), "some": (3, 2, 13.0)}
    assert got["one"]["observed_membership_statuses"] == []
    assert got["some"]["observed_membership_statuses"] == [f"s{i:02}" for i in range(10)]
