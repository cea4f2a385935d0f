"""Monthly membership status and its roll-up to companies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity360 import constants as C
from entity360.functions.collect import ordered_ids
from entity360.functions.exprs import (
    default_category,
    merge_money,
    money_limbs,
    money_value,
    review_flag,
    times_money,
)
from entity360.operators.bridge import bridge_lookup
from entity360.operators.relational import first_of_month, in_period
from entity360.sources.schemas import MEMBERSHIP_STATUS_SCHEMA

# What a row is grouped by before its canonical company is looked up.
SOURCE_GRAIN = (
    "month_start",
    "officernd_company_id",
    "location_id",
    "location_name",
    "location_code",
    "membership_category",
    "plan_id",
    "plan_name",
)
# The same in the order to sort by: the company tells most rows of a task apart.
COMPANY_FIRST = sorted(SOURCE_GRAIN, key=lambda name: name != "officernd_company_id")
_ALONE, _STATE, _MEMBERSHIP, _MEMBER = range(4)  # what a row of a group stands for
TOTALS = ("total_mrr", "total_calculated_list_price", "total_calculated_discount_amount")


def contracted_months(months: DataFrame, as_of: date, period: str) -> DataFrame:
    """Contracted month rows of the period; a NULL contract flag drops the row."""
    kept = in_period(months.where(F.col("is_contracted_in_month")), "month_start", as_of, period)
    return kept.withColumnRenamed("company_id", "officernd_company_id").withColumn(
        "membership_category", default_category(F.col("membership_category"))
    )


def membership_month_rows(
    months: DataFrame, bridge: DataFrame, as_of: date, period: str = "past_current"
) -> DataFrame:
    """Contracted month rows with their canonical company."""
    rows = contracted_months(months, as_of, period).drop("is_contracted_in_month")
    return bridge_lookup(rows, bridge, C.OFFICERND, "officernd_company_id")


def _company_links(bridge: DataFrame) -> DataFrame:
    """Bridge rows of the workspace system, one per (source id, canonical id)."""
    return (
        bridge.where(F.col("source_system") == C.OFFICERND)
        .groupBy(F.col("source_company_id").alias("_id"), "canonical_company_id")
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.bool_or(review_flag(F.col("requires_manual_review"))).alias("_review"),
            F.min("match_confidence").alias("min_match_confidence"),
        )
    )


def _price(*names: str) -> Column:
    return F.coalesce(*[F.col(name) for name in names], F.lit(0.0))


def membership_status(
    months: DataFrame, bridge: DataFrame, as_of: date, period: str = "past_current"
) -> DataFrame:
    """One row per month, company, location, category and plan.

    The month rows are aggregated before the bridge is joined: every bridge column is
    a function of the company, which is part of the grain. A mapping that lists a
    pair twice counts its money twice, as a row-level join would; ``_copies`` carries
    that.

    The months are read once, and moved once: dealt out by the grain as they are, narrower than
    anything made of them. All further steps work within the grain, so they find their rows in
    place, in the order of a sort that spills where a task has too little memory; no table of groups
    is held. A month alone in its group stays one row. Others become one row per state, membership and
    member, whose distinct values are ranked: the greatest rank is their count, and of the states
    only the first few are gathered. The row with the state carries the money.
    """
    prices = {
        "total_mrr": _price("discounted_price", "price"),
        "total_calculated_list_price": _price("calculated_list_price", "discounted_price", "price"),
        "total_calculated_discount_amount": _price("calculated_discount_amount"),
    }
    group = Window.partitionBy(*COMPANY_FIRST)
    item = "named_struct('kind', {0}, 'value', {1})"
    items = [item.format(_STATE, "membership_status")] + [
        f"IF({name} IS NULL, NULL, {item.format(kind, name)})"
        for kind, name in ((_MEMBERSHIP, "membership_id"), (_MEMBER, "member_id"))
    ]
    alone = f"array({item.format(_ALONE, 'membership_status')})"
    rows = (
        contracted_months(months, as_of, period)
        .select(
            *SOURCE_GRAIN,
            "membership_status",
            "membership_id",
            "member_id",
            *[price.alias(name) for name, price in prices.items()],
        )
        .repartition(*SOURCE_GRAIN)
        .withColumn("_months", F.count(F.lit(1)).over(group))
        .select(
            *SOURCE_GRAIN,
            *prices,
            F.col("membership_id").isNotNull().cast("int").alias("_membership"),
            F.col("member_id").isNotNull().cast("int").alias("_member"),
            F.expr(f"IF(_months = 1, {alone}, array_compact(array({', '.join(items)})))").alias("_items"),
        )
        .withColumn("_item", F.explode("_items"))
        .select("*", "_item.kind", "_item.value")
        .drop("_items", "_item")
    )
    kind, value, rank = F.col("kind"), F.col("value"), F.col("_rank")
    whole = kind.isin(_ALONE, _STATE)
    by_value = Window.partitionBy(*COMPANY_FIRST, "kind").orderBy(value.asc_nulls_last())

    def distinct(of: int, known: str) -> Column:
        count = F.max(F.when(kind == of, rank).when(kind == _ALONE, F.col(known)))
        return F.coalesce(count, F.lit(0)).cast("bigint")

    grain = (
        rows.withColumn("_rank", F.dense_rank().over(by_value))
        .withColumns({name: money_limbs(F.when(whole, F.col(name))) for name in prices})
        .groupBy(*COMPANY_FIRST)
        .agg(
            distinct(_MEMBERSHIP, "_membership").alias("active_memberships"),
            distinct(_MEMBER, "_member").alias("active_members"),
            *[merge_money(F.col(name)).alias(name) for name in TOTALS],
            F.sort_array(F.collect_set(F.when(whole & (rank <= C.STATUS_LIMIT), value))).alias(
                "observed_membership_statuses"
            ),
        )
    )

    copies = F.col("_copies")

    def repeated(name: str) -> Column:
        total = F.col(name)
        return F.when(copies > 1, times_money(total, copies)).otherwise(total)

    return (
        grain.join(_company_links(bridge), F.col("_id") == F.col("officernd_company_id"), "left")
        .withColumns(
            {
                "canonical_company_id_is_null": F.col("canonical_company_id").isNull(),
                "has_manual_review_mapping": review_flag(F.col("_review")),
                **{name: repeated(name) for name in TOTALS},
            }
        )
        .withColumns({name: money_value(F.col(name)) for name in TOTALS})
        .select(*MEMBERSHIP_STATUS_SCHEMA.fieldNames())
    )


# What is gathered per company: kind -> column. The month also carries the measures.
HISTORY_KINDS = {
    "month": "month_start",
    "company": "officernd_company_id",
    "location": "location_id",
    "category": "membership_category",
}
CURRENT_KINDS = {
    "current_location_ids": "location_id",
    "current_location_names": "location_name",
    "current_location_codes": "location_code",
    "current_membership_categories": "membership_category",
}
CURRENT_PLANS = {"current_plan_ids": "plan_id", "current_plan_names": "plan_name"}


def _company_values(status: DataFrame, month: date) -> DataFrame:
    """Distinct values per company and kind, with the measures on the month's rows.

    Each status row is turned into one row per kind and added up on (company, kind,
    value) at once, so the shuffle carries distinct values only and a company with very
    many rows is spread over its values.
    """

    def entry(kind: str, column: str) -> str:
        return f"named_struct('kind', '{kind}', 'value', CAST({column} AS STRING))"

    current = f"month_start = DATE '{month.isoformat()}'"
    entries = [entry(k, c) for k, c in HISTORY_KINDS.items()]
    entries += [
        f"CASE WHEN {current} THEN {entry(k, c)} END"
        for k, c in (CURRENT_KINDS | CURRENT_PLANS).items()
    ]
    limbs = {name: money_limbs(F.col(name)) for name in TOTALS}
    rows = (
        status.withColumns(limbs)
        .withColumn("_entry", F.expr(f"explode(array({', '.join(entries)}))"))
        .where("_entry.value IS NOT NULL")
    )
    measured = F.col("_entry.kind") == "month"

    def on_month(name: str) -> Column:
        return F.when(measured, F.col(name))

    def money(name: str, alias: str) -> Column:
        return merge_money(on_month(name)).alias(alias)

    return rows.groupBy(
        "canonical_company_id",
        F.col("_entry.kind").alias("kind"),
        F.col("_entry.value").alias("value"),
    ).agg(
        F.sum(on_month("active_memberships")).alias("memberships"),
        F.sum(on_month("active_members")).alias("members"),
        money("total_mrr", "mrr"),
        money("total_calculated_list_price", "list_price"),
        money("total_calculated_discount_amount", "discount"),
        F.bool_or(on_month("has_manual_review_mapping")).alias("review"),
        F.min(on_month("min_match_confidence")).alias("confidence"),
    )


def membership_rollup(status: DataFrame, as_of: date) -> DataFrame:
    """Current-month and historical membership per mapped company, in one pass.

    Member counts add up per-group distinct counts, so a member in two plans counts
    twice: the sums are semi-additive. ``has_active_membership`` only says that a row of
    the current month exists. Without such a row the ``current_`` columns are NULL, apart
    from the arrays, which are empty. Values are ranked per company and kind before they
    are gathered, so of the plans only the limited number is.
    """
    month = first_of_month(as_of)
    mapped = in_period(
        status.where(F.col("canonical_company_id").isNotNull()),
        "month_start",
        as_of,
        "past_current",
    )
    kind, value = F.col("kind"), F.col("value")
    now = (kind == "month") & (value == month.isoformat())
    months = F.when(kind == "month", value).cast("date")

    rank = F.row_number().over(Window.partitionBy("canonical_company_id", "kind").orderBy("value"))

    def values_of(name: str) -> Column:
        listed = kind == name
        if name in CURRENT_PLANS:
            listed &= F.col("_rank") <= C.PLAN_LIMIT
        return ordered_ids(value, listed)

    def total(name: str, when: Column | None = None) -> Column:
        return money_value(merge_money(F.col(name) if when is None else F.when(when, F.col(name))))

    return (
        _company_values(mapped, month)
        .withColumn("_rank", rank)
        .groupBy("canonical_company_id")
        .agg(
            # Current month.
            F.max(F.when(now, F.lit(True))).alias("has_active_membership"),
            *[values_of(name).alias(name) for name in CURRENT_KINDS | CURRENT_PLANS],
            F.sum(F.when(now, F.col("memberships"))).alias("current_active_memberships"),
            F.sum(F.when(now, F.col("members"))).alias("current_active_members"),
            total("mrr", now).alias("current_total_mrr"),
            total("list_price", now).alias("current_total_calculated_list_price"),
            total("discount", now).alias("current_total_calculated_discount_amount"),
            F.min(F.when(now, F.col("confidence"))).alias(
                "current_membership_min_match_confidence"
            ),
            F.bool_or(F.when(now, F.col("review"))).alias(
                "has_current_membership_manual_review_mapping"
            ),
            # All months so far.
            F.min(months).alias("first_membership_month"),
            F.max(months).alias("most_recent_membership_month"),
            F.count_if(kind == "month").alias("membership_month_count"),
            F.count_if(kind == "company").alias("membership_officernd_company_count"),
            F.count_if(kind == "location").alias("membership_location_count"),
            values_of("category").alias("all_membership_categories"),
            F.sum("memberships").alias("membership_month_active_membership_sum"),
            F.sum("members").alias("membership_month_active_member_sum"),
            total("mrr").alias("membership_month_total_mrr"),
            F.bool_or("review").alias("has_membership_manual_review_mapping"),
            F.min("confidence").alias("membership_min_match_confidence"),
        )
    )


CURRENT_COLUMNS = (
    "canonical_company_id",
    "has_active_membership",
    "current_location_ids",
    "current_location_names",
    "current_location_codes",
    "current_membership_categories",
    "current_plan_ids",
    "current_plan_names",
    "current_active_memberships",
    "current_active_members",
    "current_total_mrr",
    "current_total_calculated_list_price",
    "current_total_calculated_discount_amount",
    "current_membership_min_match_confidence",
    "has_current_membership_manual_review_mapping",
)
HISTORY_COLUMNS = (
    "canonical_company_id",
    "first_membership_month",
    "most_recent_membership_month",
    "membership_month_count",
    "membership_officernd_company_count",
    "membership_location_count",
    "all_membership_categories",
    "membership_month_active_membership_sum",
    "membership_month_active_member_sum",
    "membership_month_total_mrr",
    "has_membership_manual_review_mapping",
    "membership_min_match_confidence",
)


def current_membership(status: DataFrame, as_of: date) -> DataFrame:
    """Companies with a row in the current month, and their ``current_`` columns.

    The month filter goes in front, so only the current month is read.
    """
    rollup = membership_rollup(in_period(status, "month_start", as_of, "current"), as_of)
    return rollup.select(*CURRENT_COLUMNS)


def membership_history(status: DataFrame, as_of: date) -> DataFrame:
    """History columns of every company with a month so far."""
    return membership_rollup(status, as_of).select(*HISTORY_COLUMNS)
