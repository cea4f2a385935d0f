"""What the physical plans must look like."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from entity360.operators.quality import expectation_report
from entity360.plans.company_mart import engagement_lists
from entity360.plans.engagement_ledger import membership_events
from entity360.plans.membership import contracted_months, membership_rollup, membership_status
from entity360.registry import Product
from entity360.sources.sample import AS_OF

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def product(spark):
    return Product(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plan as if every side were big."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_ranking_is_limited_before_the_shuffle(product, no_broadcast):
    text = plan(engagement_lists(product.ledger))
    assert text.count("WindowGroupLimit") == 2
    first, last = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning" in text[first:last]


def test_status_reads_the_months_once(product, no_broadcast):
    text = plan(product.status)
    assert text.count("FileScan parquet [l_orderkey") == 1
    # Per value, per state, per row of the grain, and for the bridge join on the company; the
    # companies' own links have two more.
    assert text.count("Exchange hashpartitioning") <= 6


def test_rollup_reads_the_status_once(spark, product, tmp_path):
    path = str(tmp_path / "status")
    product.status.write.parquet(path)
    assert plan(membership_rollup(spark.read.parquet(path), AS_OF)).count("FileScan") == 1


def test_company_mart_works_out_its_inputs_once(product):
    text = plan(product.mart)
    assert text.count("FileScan") <= 18
    assert text.count("FileScan parquet [l_") <= 4


def test_reports_read_stored_models(product):
    report = expectation_report(product.stored_models)
    text = plan(report)
    assert text.count("FileScan parquet [l_") == 0 and text.count("FileScan parquet [o_") == 0


def test_company_mart_joins_share_one_partitioning(product, no_broadcast):
    text = plan(product.mart)
    joins = [line for line in text.splitlines() if "SortMergeJoin [canonical_company_id" in line]
    # Dimension with three representatives, membership, engagements with lists.
    assert len(joins) == 6
    # No such join's output is shuffled again on its way to the next one.
    nodes = [line for line in text.splitlines() if "Project" not in line and "Sort [" not in line]
    for above, below in zip(nodes, nodes[1:], strict=False):
        if "SortMergeJoin [canonical_company_id" in below:
            assert "Exchange" not in above


def test_ledger_reads_the_bridge_once_for_all_branches(product, no_broadcast):
    text = plan(product.ledger)
    assert text.count("FileScan parquet [s_suppkey") == 1


def test_filters_and_columns_reach_the_scan(product):
    text = plan(contracted_months(product.sources["int_membership_months"], AS_OF, "past_current").select("plan_id"))
    assert "GreaterThan(l_discount,0.01)" in text
    read = text[text.index("ReadSchema") :]
    assert "l_extendedprice" not in read and "l_returnflag" not in read


def test_month_filter_is_pushed_into_a_published_table(spark, product, tmp_path):
    path = str(tmp_path / "status")
    product.status.write.partitionBy("month_start").parquet(path)
    rollup = membership_rollup(spark.read.parquet(path), AS_OF)
    text = plan(rollup.select("current_plan_ids"))
    assert "PartitionFilters" in text and "month_start" in text


@pytest.fixture()
def eager_skew_join(spark, no_broadcast):
    """Treat even tiny partitions as skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.files.maxPartitionBytes": "50KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot(df, column):
    """A third of all rows on one company."""
    share = F.crc32("membership_id") % 3 == 0
    return df.withColumn(column, F.when(share, "2").otherwise(F.col(column)))


def test_hot_company_is_split_in_the_bridge_join(spark, product, eager_skew_join):
    detail = hot(product.sources["int_membership_detail"].repartition(6), "company_id")
    events = membership_events(detail, product.bridge, AS_OF)
    rows = events.collect()
    assert len(rows) == detail.count()
    assert "skew=true" in plan(events)


def test_hot_company_gives_whole_results(spark, product):
    """Its totals are those of the rows, counted one by one in Python."""
    months = hot(product.sources["int_membership_months"], "company_id")
    status = membership_status(months, product.bridge, AS_OF)
    ids, cents = set(), 0
    for row in contracted_months(months, AS_OF, "past_current").collect():
        if row["officernd_company_id"] == "2":
            key = [row[c] for c in ("month_start", "location_id", "membership_category", "plan_id")]
            ids.add((*key, row["membership_id"]))
            price = row["discounted_price"]
            price = row["price"] if price is None else price
            cents += Decimal(repr(price or 0.0))
    got = status.where("officernd_company_id = '2'").agg(
        F.sum("active_memberships"), F.sum("total_mrr")
    )
    count, total = got.first()
    assert count == len(ids)
    assert total == pytest.approx(float(cents), rel=1e-12)


def test_hot_company_lists_match_brute_force(spark, product):
    """Timeline of the hot company against a plain sort of all its events."""
    detail = hot(product.sources["int_membership_detail"], "company_id")
    events = membership_events(detail, product.bridge, AS_OF)
    mine = [r for r in events.collect() if r["canonical_company_id"] == "ent-1"]
    mine.sort(key=lambda r: r["engagement_event_id"])
    mine.sort(key=lambda r: r["start_date"], reverse=True)
    got = engagement_lists(events).where("canonical_company_id = 'ent-1'").first()
    names = [x["engagement_name"] for x in got["engagement_timeline"]]
    assert names == [r["engagement_name"] for r in mine[:20]]
