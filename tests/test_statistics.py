"""Statistics of published tables, and the joins that they decide."""

import pytest
from pyspark.sql import functions as F

from entity360.operators.bridge import bridge_lookup
from entity360.operators.publish import TABLE, keep_statistics, publish
from entity360.plans.product import STATISTICS_COLUMNS, publish_models
from entity360.session import COST_SETTINGS, tune
from entity360.sources.sample import AS_OF, SampleSources

FOLDER = "/root/testdata/sf0.001"
KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", *COST_SETTINGS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def known(spark, table):
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").collect()
    return rows[0].data_type if rows else ""


def column_statistics(spark, table, column):
    return {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}


@pytest.fixture
def costs(spark):
    """Choices are made before the query runs, and 40 KB count as small."""
    before = {key: spark.conf.get(key, None) for key in KEYS}
    tune(spark, costs=True)
    spark.conf.set(KEYS[0], str(40 << 10))
    spark.conf.set(KEYS[1], "false")
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def bridge(spark):
    """20,000 companies of 200 systems."""
    system = F.when(F.col("id") % 200 == 0, F.lit("officernd")).otherwise(F.concat(F.lit("s"), F.col("id") % 200))
    rows = spark.range(20_000).select(
        system.alias("source_system"),
        F.concat(F.lit("company-"), F.col("id")).alias("source_company_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("canonical_company_id"),
        F.lit(False).alias("requires_manual_review"),
        F.rand(1).alias("match_confidence"),
    )
    publish(rows, "measured_bridge", TABLE, namespace="measured")
    yield "measured.measured_bridge"
    spark.sql("DROP TABLE measured.measured_bridge")


def test_a_side_that_is_small_after_its_filter_is_broadcast(spark, costs, bridge):
    events = spark.range(50_000).select(F.concat(F.lit("company-"), F.col("id")).alias("company"), F.col("id"))
    publish(events, "measured_events", TABLE, namespace="measured")

    def lookup(system):
        return bridge_lookup(spark.table("measured.measured_events"), spark.table(bridge), system, "company")

    want = sorted(map(str, lookup("officernd").collect()))
    assert "BroadcastHashJoin" not in plan(lookup("officernd"))
    keep_statistics(spark, "measured_bridge", STATISTICS_COLUMNS["bridge_company_source"], namespace="measured")
    assert "BroadcastHashJoin" in plan(lookup("officernd"))
    assert "BroadcastHashJoin" not in plan(lookup(F.concat(F.lit("s"), F.col("id") % 200)))
    assert sorted(map(str, lookup("officernd").collect())) == want
    spark.sql("DROP TABLE measured.measured_events")


def test_statistics_go_when_the_table_is_written_again(spark, costs, bridge):
    keep_statistics(spark, "measured_bridge", ["source_system"], namespace="measured")
    assert "20000 rows" in known(spark, bridge)
    assert column_statistics(spark, bridge, "source_system")["distinct_count"] in map(str, range(180, 221))
    spark.table(bridge).limit(0).write.insertInto(bridge)
    assert "rows" not in known(spark, bridge)


def test_every_published_table_is_measured(spark):
    sources = SampleSources(spark, FOLDER)
    published = publish_models(sources, AS_OF, {"data": "table"}, namespace="measured_all", statistics=True)
    for name, columns in STATISTICS_COLUMNS.items():
        assert f"{published.row_counts[name]} rows" in known(spark, f"measured_all.{name}")
        for column in columns:
            found = column_statistics(spark, f"measured_all.{name}", column)
            assert int(found["distinct_count"]) >= 1 and found["num_nulls"] != "NULL"
    companies = column_statistics(spark, "measured_all.dim_company", "canonical_company_id")
    assert abs(int(companies["distinct_count"]) / published.row_counts["dim_company"] - 1) < 0.2
    for name in published:
        spark.sql(f"DROP TABLE measured_all.{name}")
