from entity360.operators import quality as q
from entity360.operators.reconcile import full_reconcile, reconcile_mismatches, reconcile_summary
from entity360.sources import SOURCE_SCHEMAS
from tests.fixtures import JUNE, bridge, collect, frame, link
from tests.test_ledger import deals, detail, services


def test_row_expectations(spark):
    b = bridge(spark)
    assert q.expect_not_null(b, "match_confidence").count() == 2
    # NULL passes accepted values.
    assert q.expect_accepted(b, "canonical_company_id", ["A", "B", "C"]).count() == 1


def test_uniqueness_with_and_without_nulls(spark):
    b = bridge(spark)
    keys = ["canonical_company_id"]
    assert {r["canonical_company_id"] for r in collect(q.expect_unique(b, keys))} == {"A"}
    grouped = collect(q.expect_unique(b, keys, nulls="group"))
    assert {(r["canonical_company_id"], r["row_count"]) for r in grouped} == {("A", 4), (None, 2)}


def test_relationship_skips_nulls(spark):
    child = spark.createDataFrame([("A",), ("X",), ("X",), (None,)], "k string")
    orphans = q.expect_relationship(child, "k", bridge(spark), "canonical_company_id")
    assert [r["k"] for r in collect(orphans)] == ["X", "X"]


def test_check_table(spark):
    report = q.check_table(bridge(spark), "b", ["source_system", "match_confidence"], {"source_system": ["hubspot"]})
    got = {(r["expectation"], r["column_name"]): r["failing_rows"] for r in collect(report)}
    assert got == {
        ("not_null", "source_system"): 0,
        ("not_null", "match_confidence"): 2,
        ("accepted_values", "source_system"): 5,
    }


def test_duplicate_mappings(spark):
    rows = [link("hubspot", "1", c) for c in ("A", "B", "C")] + [link("bigtime", "9", "A")] * 2
    got = collect(q.duplicate_mappings(bridge(spark, rows)))
    assert [(r["source_company_id"], r["row_count"]) for r in got] == [("1", 3), ("9", 2)]
    assert len(collect(q.duplicate_mappings(bridge(spark, rows), limit=1))) == 1


def test_multi_id_groups(spark):
    rows = [link("hubspot", f"{i:02d}", "A", i % 2 == 0, 0.5) for i in range(30)]
    rows += [link("hubspot", "x", None, True), link("hubspot", "y", None, None, 0.1)]
    rows += [link("hubspot", "z", "B"), link("hubspot", "z", "B")]
    got = collect(q.multi_id_groups(bridge(spark, rows)))
    assert [r["canonical_company_id"] for r in got] == ["A", None]
    assert got[0]["source_company_id_count"] == 30 and got[0]["manual_review_rows"] == 15
    assert got[0]["sample_source_company_ids"] == [f"{i:02d}" for i in range(20)]
    assert got[1]["sample_source_company_ids"] == ["x", "y"]
    assert got[1]["min_match_confidence"] == 0.1


def test_mapping_coverage(spark):
    counts = q.source_company_counts(*deals(spark), detail(spark), services(spark))
    rows = {r["source_system"]: r for r in collect(q.mapping_coverage(counts, bridge(spark)))}
    assert rows["hubspot"]["row_count"] == 3 and rows["hubspot"]["null_canonical_rows"] == 1
    assert rows["officernd"]["null_canonical_rate"] == 0.5
    assert rows["bigtime"]["manual_review_rows"] == 1
    # A mapping without a flag counts as needing a review.
    assert rows["hubspot"]["manual_review_rows"] == 3


def test_smoke_reports(spark):
    mart = spark.createDataFrame(
        [
            ("A", "n", True, False, "active_member", 2, 1, 1.005, True, True, False, 3, 1, 0),
            ("B", None, False, False, "active_member", 1, 1, 2.0, False, True, False, 0, 4, 0),
            (None, None, None, True, "former_member", 0, 0, 0.0, False, False, False, 0, 0, 0),
            (None, "x", None, True, "former_member", 0, 0, 0.0, False, False, False, 0, 0, 0),
        ],
        "canonical_company_id string, company_name string, has_any_manual_review_mapping boolean, "
        "has_identity_manual_review_mapping boolean, membership_status string, "
        "current_active_memberships bigint, current_active_members bigint, current_total_mrr double, "
        "has_deal_engagement boolean, has_membership_engagement boolean, has_project_engagement boolean, "
        "deal_engagement_count bigint, membership_engagement_count bigint, project_engagement_count bigint",
    )
    assert collect(q.null_counts(mart, ["company_name"])) == [{"null_company_name_count": 2}]
    assert collect(q.duplicate_companies(mart)) == [{"canonical_company_id": None, "row_count": 2}]
    assert collect(q.review_counts(mart)) == [
        {"manual_review_company_count": 1, "identity_manual_review_company_count": 2}
    ]
    status = {r["membership_status"]: r for r in collect(q.status_distribution(mart))}
    # 3.005 rounds half away from zero.
    assert status["active_member"]["current_total_mrr"] == 3.01
    kinds = {r["engagement_type"]: r for r in collect(q.engagement_distribution(mart))}
    assert kinds["membership"]["companies_with_engagement_type"] == 2
    assert kinds["membership"]["engagement_count"] == 5
    assert collect(q.row_counts({"m": mart})) == [{"model_name": "m", "row_count": 4}]


KEYS = ["month_start", "company_id", "location_id", "membership_category", "plan_id"]


def side(spark, *rows):
    full = [
        {
            "month_start": JUNE,
            "company_id": c,
            "location_id": loc,
            "membership_category": "x",
            "plan_id": "p",
            "active_memberships": n,
            "active_members": 1,
            "total_mrr": m,
        }
        for c, loc, n, m in rows
    ]
    return frame(spark, "mart_membership_detail", full)


def test_reconcile_null_keys(spark):
    left, right = side(spark, ("1", None, 1, 1.0)), side(spark, ("1", None, 1, 1.0))
    assert full_reconcile(left, right, KEYS, ["active_members"]).count() == 2
    assert full_reconcile(left, right, KEYS, ["active_members"], null_safe=True).count() == 1
    assert reconcile_mismatches(left, right).count() == 2
    assert reconcile_mismatches(left, right, null_safe=True).count() == 0


def test_reconcile_mismatches_and_summary(spark):
    left = side(spark, ("1", "L", 1, 1.0), ("2", "L", 1, 1.001), ("3", "L", 2, 5.0), ("4", "L", 1, 1.004))
    right = side(spark, ("1", "L", 1, 1.0), ("2", "L", 1, 1.002), ("3", "L", 3, 5.0), ("5", "L", 1, 7.0), ("4", "L", 1, 1.006))
    bad = {r["company_id"] for r in collect(reconcile_mismatches(left, right).where("company_id != '4'"))}
    assert bad == {"3", "5"}
    # Rounding flips between 1.004 and 1.006; a tolerance does not.
    assert "4" in {r["company_id"] for r in collect(reconcile_mismatches(left, right))}
    assert "4" not in {r["company_id"] for r in collect(reconcile_mismatches(left, right, tolerance=0.005))}
    total = collect(reconcile_summary(left, right))[0]
    assert total["reconciled_key_rows"] == 5
    assert (total["missing_from_production"], total["missing_from_existing"]) == (1, 0)
    assert total["abs_total_mrr_diff"] == 7.0
    assert (total["production_active_memberships"], total["existing_active_memberships"]) == (5, 7)


def test_expectation_lists_name_existing_columns():
    from entity360.sources import schemas as s

    columns = {
        "bridge_company_source": SOURCE_SCHEMAS["int_cross_source_companies"],
        "dim_company": s.DIM_COMPANY_SCHEMA,
        "fct_engagement_ledger": s.LEDGER_SCHEMA,
        "mart_membership_status": s.MEMBERSHIP_STATUS_SCHEMA,
        "company_mart": s.COMPANY_MART_SCHEMA,
    }
    for rules in (q.NOT_NULL, q.ACCEPTED, q.UNIQUE, q.UNIQUE_COMBINATION):
        for model, names in rules.items():
            assert set(names) <= set(columns[model].fieldNames()), model


def test_repeated_texts_are_counted_by_their_own_spelling(spark):
    """Hexadecimal texts move as bytes; no two texts are taken for one."""
    texts = ["", "", "ab", "AB", "ab", "0ab", "ab ", "zz", "zz", "a", "a", "00", "0", "é", "é", None, None]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    twice = {t: texts.count(t) for t in texts if texts.count(t) > 1}
    found = {r["id"]: r["row_count"] for r in q.expect_unique(df, ["id"], nulls="group").collect()}
    assert found == twice
    del twice[None]
    unique = q.expect_unique(df, ["id"])
    assert {r["id"]: r["row_count"] for r in unique.collect()} == twice
    assert unique.schema["id"].dataType.simpleString() == "string"
    text = unique._jdf.queryExecution().executedPlan().toString()
    assert "unhex(" in text[text.index("Exchange") :]
