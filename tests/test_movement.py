"""How often rows are moved, with every side planned as if it were big."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entity360 import constants as C
from entity360 import registry
from entity360.operators.bridge import is_small
from entity360.plans import company_mart as mart
from entity360.plans.engagement_ledger import project_partners
from entity360.plans.product import build_ledger
from entity360.registry import Product, flat
from entity360.session import stored
from entity360.sources.sample import AS_OF

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def product(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield Product(spark, FOLDER)
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_moves_the_months_once_before_the_bridge_join(product):
    text = plan(product.status)
    months = text[text.index("Generate explode") :]
    months = months[: months.index("FileScan")]
    assert months.count("Exchange hashpartitioning") == 1
    # One for the months, one per side of the bridge join, one in the links' own aggregate at most.
    assert text.count("Exchange hashpartitioning") <= 4


def test_existing_mart_moves_its_lines_once(product):
    assert plan(product.reconciled[1]).count("Exchange hashpartitioning") == 1


def test_event_keys_are_hashed_after_the_bridge_join(product):
    text = plan(product.ledger)
    assert "sha2(" in text[: text.index("SortMergeJoin")]
    assert "sha2(" not in text[text.index("SortMergeJoin") :]


def test_smoke_reports_store_the_mart_alone(spark, product):
    """Of the models below, only what the mart reads twice is stored, and no whole ledger."""
    registry._duplicate_companies(product)
    registry._row_counts(product)
    assert "stored_models" not in vars(product)
    assert product.stored_mart.count() == product.dim.count()


def test_groups_of_the_grain_are_added_up_in_order(product):
    """Nearly every month is a group of its own, so no step may hold a table of groups, which spills."""
    months = plan(product.status).split("SortMergeJoin")[1].split("HashAggregate(keys=[source_company_id")[0]
    months = months[: months.index("FileScan")]
    assert "HashAggregate" not in months and months.count("SortAggregate") == 2
    assert "HashAggregate" not in plan(product.reconciled[1])


def test_lists_need_only_the_newest_events_of_source_companies(product):
    """Cut ahead of the shuffle to the bridge, and still the lists of the whole ledger."""
    lists = mart.engagement_lists(product.newest)
    # Twice per branch that is cut, around its shuffle, and twice in the lists themselves.
    assert plan(lists).count("WindowGroupLimit") == 6
    whole = flat(mart.engagement_lists(product.ledger)).collect()
    assert sorted(flat(lists).collect()) == sorted(whole)
    assert product.newest.count() < product.ledger.count()


def small_ledger(product, **options):
    """The ledger as built where the workspace part of the bridge is small."""
    return build_ledger(product.sources, product.bridge, AS_OF, small_workspace=True, **options)


def test_wide_events_are_not_shuffled_to_the_bridge(product):
    """Memberships stay where they are, deals and projects are looked up by their links."""
    text = plan(small_ledger(product))
    assert text.count("BroadcastHashJoin") == 1
    assert text.count("hashpartitioning(source_company_id") == 1  # services projects
    # Links of deals and of projects.
    assert text.count("hashpartitioning(_company") == 2
    assert text.count("FileScan parquet [s_suppkey") == 1


def test_small_workspace_changes_no_event(product):
    assert sorted(small_ledger(product).collect(), key=str) == sorted(product.ledger.collect(), key=str)
    whole = flat(mart.engagement_lists(product.ledger)).collect()
    small = small_ledger(product, newest=C.TIMELINE_LIMIT, short_keys=True)
    assert sorted(flat(mart.engagement_lists(small)).collect()) == sorted(whole)


def test_workspace_is_small_by_its_rows(spark, product):
    """Counted, up to the limit, and never where broadcasts are off."""
    rows = product.bridge.where(F.col("source_system") == C.OFFICERND).count()
    assert not is_small(product.bridge, C.OFFICERND)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert is_small(product.bridge, C.OFFICERND) and is_small(product.bridge, C.OFFICERND, rows)
    assert not is_small(product.bridge, C.OFFICERND, rows - 1)


def test_partner_links_are_moved_as_they_are(product):
    sources = product.sources
    text = plan(project_partners(sources["hubspot.projects_to_company"], sources["hubspot.company"]))
    # Both steps of the arrays follow the shuffle.
    last = text.index("REPARTITION_BY_COL")
    assert "collect_set" in text[:last] and "collect_set" not in text[last:]


def test_shuffle_files_go_with_their_query(spark, product):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = kept.size()
    stored(product.ledger)
    assert kept.size() <= before


def test_lists_sort_by_short_keys_and_cut_memberships_once(spark, product):
    """Half the characters to move, and no cut of memberships ahead of that of the lists."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    newest = product.newest
    assert newest.schema["engagement_event_id"].dataType == T.BinaryType()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert plan(mart.engagement_lists(newest)).count("WindowGroupLimit") == 4


def test_scan_tasks_are_small_enough_to_sort(spark, product, tmp_path):
    """Two groups of rows of 20 MB are two tasks."""
    path = str(tmp_path / "wide")
    rows = spark.range(0, 5_000_000, 1, 1).select(F.xxhash64("id").alias("n"))
    rows.write.option("parquet.block.size", 20 << 20).parquet(path)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    tasks = spark.read.parquet(path).rdd.getNumPartitions()
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert tasks == 2


def test_smoke_reports_store_lists_and_totals_instead_of_events(product, monkeypatch):
    """What they read of the mart is built from parts that hold one row a company."""
    kept = []
    monkeypatch.setattr(registry, "stored", lambda df: kept.append(df.columns) or df)
    registry._duplicate_companies(product)
    registry._row_counts(product)
    assert len(kept) == 4  # lists, totals, dimension and mart
    assert not any("engagement_event_id" in columns for columns in kept)
