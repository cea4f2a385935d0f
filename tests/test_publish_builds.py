"""Checks tied to a build, bucketed layouts, partition-wise replacement, views of the catalog."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from entity360.operators.publish import Buckets, publish, publish_view, replace_partitions
from entity360.operators.quality import (
    ExpectationFailed,
    WriteChecks,
    expectation_report,
    require_passed,
)
from entity360.operators.reconcile import NotReconciled, reconcile_mismatches, require_reconciled
from entity360.plans.company_mart import company_mart
from entity360.plans.product import build_models, publish_models
from entity360.sources.sample import AS_OF, SampleSources

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    """All rows as text; a partition column comes last in a table, so columns go by name."""
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def above_scan(df, table):
    """The operators of the plan that the rows of a table go through."""
    lines = plan(df).splitlines()
    at = next(i for i, x in enumerate(lines) if table in x and "Scan" in x)
    depth, above = lines[at].index("FileScan"), []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-|*()0123456789"))
        if indent < depth:
            depth = indent
            above.append(line)
    assert above
    return above


@pytest.fixture
def shuffled_joins(spark):
    """No side is broadcast for its size, as with large tables."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def files(spark, table):
    return {f for f in spark.table(table).inputFiles()}


# --- Checks while writing ----------------------------------------------------------------


def test_checks_while_writing_equal_the_report(spark):
    sources = SampleSources(spark, FOLDER)
    published = publish_models(sources, AS_OF, {"data": "table"}, namespace="build_checks")
    report = [tuple(r) for r in expectation_report(published).collect()]
    assert sorted(published.all_checks()) == sorted(report)
    watched = {c[:3] for c in published.row_checks}
    assert watched == {r[:3] for r in report if r[1] in ("not_null", "accepted_values")}
    assert published.row_counts == {name: df.count() for name, df in published.items()}
    # What was counted while writing isn't scanned for again.
    rest = expectation_report(published, checked=published.row_counts)
    assert not {r.expectation for r in rest.collect()} & {"not_null", "accepted_values"}
    assert expectation_report({}, ()) is None


def test_views_are_checked_by_reading_them(spark):
    published = publish_models(SampleSources(spark, FOLDER), AS_OF, {})
    assert published.row_checks == [] and published.row_counts == {}
    report = [tuple(r) for r in expectation_report(published).collect()]
    assert sorted(published.all_checks()) == sorted(report)


def test_failures_are_counted_once_per_row_and_stop_a_strict_build(spark):
    bridge = SampleSources(spark, FOLDER)["int_cross_source_companies"]
    n = bridge.count()
    odd = bridge.withColumn("source_system", F.when(F.col("source_system") == "hubspot", F.lit("other")).otherwise(F.col("source_system")))
    checks = WriteChecks("bridge_company_source")
    publish(odd, "odd_bridge", "table", namespace="build_checks", watch=checks.watch)
    found = {(kind, col): bad for _, kind, col, bad in checks.rows()}
    want = odd.where("source_system = 'other'").count()
    assert want and found["accepted_values", "source_system"] == want and checks.row_count == n
    with pytest.raises(ExpectationFailed, match=rf"accepted_values\(source_system\) fails on {want} rows"):
        require_passed(checks.rows())
    require_passed([])

    class Odd(dict):
        def __missing__(self, name):
            return SampleSources(spark, FOLDER)[name]

    with pytest.raises(ExpectationFailed, match="bridge_company_source"):
        publish_models(Odd(int_cross_source_companies=odd), AS_OF, {"data": "table"}, namespace="build_strict", strict=True)
    assert not spark.catalog.tableExists("build_strict.dim_company")


def test_checks_of_an_empty_model(spark):
    checks = WriteChecks("dim_company")
    dim = build_models(SampleSources(spark, FOLDER), AS_OF)["dim_company"]
    publish(dim.where("false"), "no_dim", "table", namespace="build_checks", watch=checks.watch)
    assert checks.row_count == 0 and {n for *_, n in checks.rows()} == {0}


def test_a_build_fails_where_tables_do_not_agree(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 0.5)], "k int, v double")
    require_reconciled(reconcile_mismatches(left, left, ["k"], {"v": 2}))
    with pytest.raises(NotReconciled, match="at least 1 rows"):
        require_reconciled(reconcile_mismatches(left, left.where("k < 3"), ["k"], {"v": 2}))


# --- Buckets -------------------------------------------------------------------------------


def test_joins_do_not_move_bucketed_models(spark, shuffled_joins):
    sources = SampleSources(spark, FOLDER)
    published = publish_models(sources, AS_OF, {"data": "table"}, namespace="build_buckets", buckets=4)
    plain = build_models(sources, AS_OF)
    for name in plain:
        assert rows(published[name]) == rows(plain[name]), name
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED build_buckets.dim_company").collect()}
    assert info["Num Buckets"] == "4" and "canonical_company_id" in info["Bucket Columns"]

    # Two bucketed models meet without any exchange or sort of whole rows.
    both = published["dim_company"].join(published["company_mart"].select("canonical_company_id", "membership_status"), "canonical_company_id")
    assert "Exchange" not in plan(both) and "SortMergeJoin" in plan(both)

    # The company mart moves its roll-ups only: no exchange lies above the scan of the dimension.
    parts = ("dim_company", "mart_membership_status", "fct_engagement_ledger")
    assert not any("Exchange" in x for x in above_scan(company_mart(*(published[n] for n in parts), AS_OF), "build_buckets.dim_company"))
    publish(published["dim_company"], "plain_dim", "table", namespace="build_buckets")
    plain_dim = spark.table("build_buckets.plain_dim")
    moved = company_mart(plain_dim, *(published[n] for n in parts[1:]), AS_OF)
    assert any("Exchange" in x for x in above_scan(moved, "build_buckets.plain_dim"))


def test_bucketed_rows_with_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), (None, 4)], "k string, v int")
    table = publish(df, "null_keys", "table", namespace="build_buckets", buckets=Buckets(3, ["k"]))
    assert rows(table) == rows(df)
    assert publish(df.where("false"), "null_keys", "table", namespace="build_buckets", buckets=Buckets(3, ["k"])).count() == 0


# --- Partition-wise replacement ------------------------------------------------------------


def month_rows(spark, extra=()):
    base = [(k, f"text {k}", [k, k + 1], date(2024, 1 + k % 4, 1)) for k in range(40)]
    return spark.createDataFrame([*base, *extra], "k int, t string, a array<int>, m date")


def test_only_partitions_that_differ_are_written(spark):
    df = month_rows(spark, [(99, "none", None, None)])
    publish(df, "by_month", "table", namespace="build_parts", partition_by=["m"])
    full = "build_parts.by_month"
    before = files(spark, full)

    same = replace_partitions(df.orderBy(F.desc("k")), "by_month", "m", namespace="build_parts")
    assert same == ([], [], 5) and files(spark, full) == before

    # One month changes in one value, one goes, one comes, and one only has a row twice.
    changed = df.withColumn("t", F.when(F.col("k") == 1, "new").otherwise(F.col("t"))).where("m IS NULL OR m <> DATE '2024-03-01'")
    changed = changed.unionByName(month_rows(spark).where("k = 3")).unionByName(
        spark.createDataFrame([(7, "later", [], date(2024, 9, 1))], changed.schema)
    )
    done = replace_partitions(changed.select("m", "a", "t", "k"), "by_month", "m", namespace="build_parts")
    assert sorted(done.written) == [date(2024, 2, 1), date(2024, 4, 1), date(2024, 9, 1)]
    assert done.dropped == [date(2024, 3, 1)] and done.kept == 2
    assert rows(spark.table(full).select(*df.columns)) == rows(changed.select(*df.columns))
    kept = {f for f in before if "m=2024-01-01" in f or "__HIVE_DEFAULT" in f}
    assert kept and kept <= files(spark, full)
    assert not {f for f in before - kept} & files(spark, full)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"

    # The NULL partition changes, comes from the table itself, and goes.
    own = spark.table(full).withColumn("t", F.when(F.col("m").isNull(), "changed").otherwise(F.col("t")))
    assert replace_partitions(own, "by_month", "m", namespace="build_parts").written == [None]
    gone = replace_partitions(spark.table(full).where("m IS NOT NULL"), "by_month", "m", namespace="build_parts")
    assert gone.dropped == [None] and spark.table(full).where("m IS NULL").count() == 0
    empty = replace_partitions(df.where("false"), "by_month", "m", namespace="build_parts")
    assert spark.table(full).count() == 0 and empty.kept == 0
    with pytest.raises(ValueError, match="other columns"):
        replace_partitions(df.drop("a"), "by_month", "m", namespace="build_parts")


def test_a_refresh_rewrites_the_month_that_changed(spark):
    sources = SampleSources(spark, FOLDER)
    first = publish_models(sources, AS_OF, {"data": "table"}, namespace="build_refresh")
    full = "build_refresh.mart_membership_status"
    before = files(spark, full)
    months = sources["int_membership_months"]
    changed_month = first["mart_membership_status"].agg(F.max("month_start")).first()[0]

    class Changed(dict):
        def __missing__(self, name):
            return sources[name]

    price = F.when(F.col("month_start") == F.lit(changed_month), F.col("price") + 1).otherwise(F.col("price"))
    new = Changed(int_membership_months=months.withColumns({"price": price, "discounted_price": F.lit(None).cast("double")}).where(F.col("month_start") == F.lit(changed_month)).unionByName(months.where(F.col("month_start") != F.lit(changed_month))))
    second = publish_models(new, AS_OF, {"data": "table"}, namespace="build_refresh", refresh=True)
    done = second.replaced["mart_membership_status"]
    assert done.written == [changed_month] and done.dropped == [] and done.kept > 1
    assert {Path(f).parent.name for f in before - files(spark, full)} == {f"month_start={changed_month}"}
    assert rows(second["mart_membership_status"]) == rows(build_models(new, AS_OF)["mart_membership_status"])
    assert second.row_counts["mart_membership_status"] == second["mart_membership_status"].count()


# --- Views of the catalog ------------------------------------------------------------------


def test_a_catalog_view_outlives_the_session(spark):
    sources = SampleSources(spark, FOLDER)
    sources["int_cross_source_companies"].write.mode("overwrite").saveAsTable("mapping_source")
    published = publish_models(sources, AS_OF, {}, namespace="build_views", bridge_table="mapping_source")
    other = spark.newSession()
    view = other.table("build_views.bridge_company_source")
    assert rows(view) == rows(build_models(sources, AS_OF)["bridge_company_source"])
    assert rows(published["bridge_company_source"]) == rows(view)
    assert other.catalog.getTable("build_views.bridge_company_source").tableType == "VIEW"
    assert other.catalog.getTable("build_views.bridge_company_source").description
    described = {r.col_name: r.comment for r in other.sql("DESCRIBE build_views.bridge_company_source").collect()}
    assert described["canonical_company_id"]
    # It shows what its table holds now.
    sources["int_cross_source_companies"].limit(3).write.mode("overwrite").saveAsTable("mapping_source")
    assert other.newSession().table("build_views.bridge_company_source").count() == 3


def test_a_catalog_view_must_not_rest_on_the_session(spark):
    spark.range(3).createOrReplaceTempView("only_here")
    with pytest.raises(Exception, match="(?i)temporary"):
        publish_view(spark, "broken", "SELECT id FROM only_here", namespace="build_views")
    with pytest.raises(ValueError, match="no such columns"):
        publish_view(spark, "broken", "SELECT 1 AS n", namespace="build_views", column_comments={"x": "?"})
    view = publish_view(spark, "quoted", "SELECT 1 AS `it's`", namespace="build_views", comment="it's", column_comments={"it's": "a \\ 'b'"})
    assert view.first()[0] == 1
    with pytest.raises(ValueError, match="namespace"):
        publish_models(SampleSources(spark, FOLDER), AS_OF, {}, bridge_table="mapping_source")
