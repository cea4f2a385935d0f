"""One wide row per company: identity, quality, memberships and engagements."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from entity360 import constants as C
from entity360.functions.collect import distinct_sorted, ranked_structs
from entity360.functions.exprs import (
    any_flag,
    exact_sum,
    lowest_of,
    membership_label,
    merge_money,
    money_value,
)
from entity360.operators.relational import with_defaults
from entity360.plans.membership import membership_rollup
from entity360.sources.schemas import (
    COMPANY_MART_SCHEMA,
    EVENT_ITEM,
    PROJECT_ITEM,
    RECENT_ITEM,
    TIMELINE_ITEM,
)


# What the roll-ups read of the ledger.
LEDGER_COLUMNS = tuple(
    dict.fromkeys(
        (
            "canonical_company_id",
            "engagement_event_id",
            "source_system",
            "engagement_type",
            "engagement_category",
            "start_date",
            "end_date",
            "amount",
            "requires_manual_review",
            "match_confidence",
            *TIMELINE_ITEM.fieldNames(),
            *PROJECT_ITEM.fieldNames(),
            *EVENT_ITEM.fieldNames(),
            *RECENT_ITEM.fieldNames(),
        )
    )
)


def mapped_events(ledger: DataFrame) -> DataFrame:
    """The ledger's part that the roll-ups read."""
    return ledger.where(F.col("canonical_company_id").isNotNull()).select(*LEDGER_COLUMNS)


def engagement_totals(ledger: DataFrame) -> DataFrame:
    """Counts, amounts, dates and vocabularies per mapped company.

    The ledger is first added up per company, system, type and category: a few rows
    per company, combined before the shuffle, from which all the rest follows.
    """
    parts = (
        ledger.where(F.col("canonical_company_id").isNotNull())
        .groupBy("canonical_company_id", "source_system", "engagement_type", "engagement_category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("start_date").alias("first_date"),
            F.max(F.coalesce("end_date", "start_date")).alias("last_date"),
            exact_sum(F.coalesce(F.col("amount"), F.lit(0.0))).alias("amount"),
            F.bool_or("requires_manual_review").alias("review"),
            F.min("match_confidence").alias("confidence"),
        )
    )
    of_type = {name: F.col("engagement_type") == name for name in C.ENGAGEMENT_TYPES}
    of_system = {name: F.col("source_system") == name for name in C.SYSTEMS}

    def count_of(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    def amount_of(condition):
        total = money_value(merge_money(F.when(condition, F.col("amount"))))
        return F.coalesce(total, F.lit(0.0))

    return parts.groupBy("canonical_company_id").agg(
        F.min("first_date").alias("first_engagement_date"),
        F.max("last_date").alias("most_recent_engagement_date"),
        F.sum("n").alias("total_engagement_count"),
        *[count_of(of_type[name]).alias(f"{name}_engagement_count") for name in of_type],
        *[count_of(of_system[name]).alias(f"{name}_engagement_count") for name in of_system],
        F.size(F.collect_set("source_system")).cast("bigint").alias("engagement_source_system_count"),
        distinct_sorted(F.col("source_system")).alias("engagement_source_systems"),
        distinct_sorted(F.col("engagement_type")).alias("engagement_types"),
        distinct_sorted(F.col("engagement_category")).alias("engagement_categories"),
        money_value(merge_money(F.col("amount"))).alias("total_source_reported_engagement_amount"),
        *[amount_of(of_type[name]).alias(f"{name}_amount") for name in of_type],
        F.bool_or("review").alias("has_engagement_manual_review_mapping"),
        F.min("confidence").alias("engagement_min_match_confidence"),
    )


def engagement_lists(ledger: DataFrame) -> DataFrame:
    """Newest engagements per mapped company: timeline, recent ones, and one list per type.

    Newest start date first, NULL dates last, the event id settling ties. Each event of
    the overall top twenty is among the top twenty of its type, so ranking within
    (company, type) first bounds every later step to twenty rows per type, and that
    filter also runs ahead of the shuffle.
    """
    newest = (F.col("start_date").desc_nulls_last(), F.col("engagement_event_id").asc_nulls_first())
    per_type = Window.partitionBy("canonical_company_id", "engagement_type").orderBy(*newest)
    overall = Window.partitionBy("canonical_company_id").orderBy(*newest)
    rank, type_rank = F.col("rank"), F.col("type_rank")

    ranked = (
        ledger.where(F.col("canonical_company_id").isNotNull())
        .select("canonical_company_id", "engagement_event_id", *TIMELINE_ITEM.fieldNames())
        .withColumn("type_rank", F.row_number().over(per_type))
        .where(type_rank <= C.TIMELINE_LIMIT)
        .withColumn("rank", F.row_number().over(overall))
    )

    def typed(name, item):
        return ranked_structs(
            type_rank, C.TYPED_LIMIT, item.fieldNames(), F.col("engagement_type") == name
        ).alias(f"{name}_engagements")

    return ranked.groupBy("canonical_company_id").agg(
        ranked_structs(rank, C.TIMELINE_LIMIT, TIMELINE_ITEM.fieldNames()).alias(
            "engagement_timeline"
        ),
        ranked_structs(rank, C.RECENT_LIMIT, RECENT_ITEM.fieldNames()).alias("recent_engagements"),
        typed(C.PROJECT, PROJECT_ITEM),
        typed(C.DEAL, EVENT_ITEM),
        typed(C.MEMBERSHIP, EVENT_ITEM),
    )


def engagement_rollup(
    ledger: DataFrame, lists: DataFrame | None = None, totals: DataFrame | None = None
) -> DataFrame:
    """Totals and lists side by side; what is not given is already partitioned by company."""
    lists = engagement_lists(ledger) if lists is None else lists
    totals = engagement_totals(ledger) if totals is None else totals
    return totals.join(lists, "canonical_company_id", "left")


def _fact_defaults() -> dict[str, object]:
    """Zero, FALSE or an empty array for each fact column; dates stay NULL."""
    names = COMPANY_MART_SCHEMA.fieldNames()
    facts = COMPANY_MART_SCHEMA.fields[names.index("has_active_membership") :]
    defaults: dict[str, object] = {}
    for field in facts:
        if isinstance(field.dataType, T.ArrayType):
            defaults[field.name] = []
        elif isinstance(field.dataType, (T.LongType, T.DoubleType)):
            defaults[field.name] = 0
    return {"has_active_membership": False, **defaults}


def mapping_quality(joined: DataFrame) -> DataFrame:
    """Identity, membership and engagement quality merged into one minimum and one flag.

    The input holds the dimension's own two columns under ``identity`` names.
    """
    return joined.withColumns(
        {
            "min_match_confidence": lowest_of(
                F.col("identity_min_match_confidence"),
                F.col("membership_min_match_confidence"),
                F.col("engagement_min_match_confidence"),
            ),
            "has_any_manual_review_mapping": any_flag(
                F.col("has_identity_manual_review_mapping"),
                F.col("has_current_membership_manual_review_mapping"),
                F.col("has_membership_manual_review_mapping"),
                F.col("has_engagement_manual_review_mapping"),
            ),
        }
    )


def company_mart(
    dim: DataFrame,
    status: DataFrame,
    ledger: DataFrame,
    as_of: date,
    lists: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Every dimension company with its facts; companies without facts get defaults.

    The ledger is read twice (totals and lists) and the status twice, so publish both as
    tables before building this at scale: see ``plans.product``. ``lists`` and ``totals`` are what
    ``engagement_lists`` and ``engagement_totals`` made of it, if that was stored before.
    """
    identity = dim.withColumnsRenamed(
        {
            "has_manual_review_mapping": "has_identity_manual_review_mapping",
            "min_match_confidence": "identity_min_match_confidence",
        }
    )
    membership = membership_rollup(status, as_of).withColumn("_has_history", F.lit(True))
    joined = identity.join(membership, "canonical_company_id", "left").join(
        engagement_rollup(ledger, lists, totals), "canonical_company_id", "left"
    )
    filled = with_defaults(mapping_quality(joined), _fact_defaults())
    counted = {
        "has_engagement": "total_engagement_count",
        "has_deal_engagement": "deal_engagement_count",
        "has_membership_engagement": "membership_engagement_count",
        "has_project_engagement": "project_engagement_count",
    }
    return filled.withColumns(
        {
            "is_multi_source_company": F.col("source_system_count") > 1,
            "membership_status": membership_label(
                F.col("current_active_memberships"), F.col("_has_history").isNotNull()
            ),
            **{flag: F.col(count) > 0 for flag, count in counted.items()},
        }
    ).select(*COMPANY_MART_SCHEMA.fieldNames())
