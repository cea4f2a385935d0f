"""Named queries over the test tables: one per operator and model."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entity360 import constants as C
from entity360.functions.collect import distinct_sorted
from entity360.functions.exprs import (
    blank_to_null,
    exact_sum,
    membership_state,
    money_value,
    normalise_status,
    surrogate_key,
)
from entity360.operators import quality, reconcile
from entity360.operators.bridge import bridge_lookup, is_small
from entity360.operators.relational import smallest_distinct
from entity360.plans import company_dimension as dimension
from entity360.plans import company_mart as mart
from entity360.plans import engagement_ledger as ledger
from entity360.plans import membership, product
from entity360.session import stored, tune
from entity360.sources.sample import AS_OF, SampleSources

KEY = "canonical_company_id"


def _text_of(value: str, kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"array_join({value}, '+')"
    return f"coalesce(CAST({value} AS STRING), '')"


def flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare by value in any engine."""
    columns = []
    for field in df.schema.fields:
        value = f"`{field.name}`"
        if isinstance(field.dataType, T.ArrayType):
            item = field.dataType.elementType
            if isinstance(item, T.StructType):
                parts = ", ".join(_text_of(f"x.`{f.name}`", f.dataType) for f in item.fields)
                value = f"transform({value}, x -> concat_ws('~', {parts}))"
            value = f"array_join({value}, ';')"
        columns.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*columns)


def unnested(df: DataFrame, array: str) -> DataFrame:
    """One row per array item with its position, counted from 1."""
    items = df.select(KEY, F.posexplode(array).alias("pos", "item"))
    return flat(items.select(KEY, (F.col("pos") + 1).cast("bigint").alias("position"), "item.*"))


class Product:
    """The models over one folder of test tables, built on demand.

    What several readers need is worked out once and stored, as when it is published: all models below the
    reports on them. The mart's lists of engagements, its widest part, and then the totals are stored before
    all else, so that the shuffles of each step are gone by the next. Reports that read a few columns of the mart take the plan as it is, so
    that only those are worked out.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.sources = SampleSources(tune(spark), folder)

    @cached_property
    def bridge(self) -> DataFrame:
        return product.build_bridge(self.sources)

    @cached_property
    def dim(self) -> DataFrame:
        return product.build_dim(self.sources, self.bridge)

    @cached_property
    def small_workspace(self) -> bool:
        return is_small(self.bridge, C.OFFICERND)

    def _ledger(self, newest: int | None = None, short_keys: bool = False) -> DataFrame:
        return product.build_ledger(
            self.sources, self.bridge, AS_OF, newest, self.small_workspace, short_keys
        )

    @cached_property
    def ledger(self) -> DataFrame:
        return self._ledger()

    @cached_property
    def newest(self) -> DataFrame:
        """What lists of newest engagements need of the ledger; they only sort by the event ids."""
        return self._ledger(C.TIMELINE_LIMIT, short_keys=True)

    @cached_property
    def status(self) -> DataFrame:
        return product.build_status(self.sources, self.bridge, AS_OF)

    @cached_property
    def lists(self) -> DataFrame:
        return stored(mart.engagement_lists(self.newest))

    @cached_property
    def totals(self) -> DataFrame:
        return stored(mart.engagement_totals(mart.mapped_events(self.ledger)))

    @cached_property
    def mart(self) -> DataFrame:
        return mart.company_mart(self.dim, self.status, self.ledger, AS_OF, self.lists, self.totals)

    @cached_property
    def narrow_mart(self) -> DataFrame:
        return mart.company_mart(self.dim, self.status, self.ledger, AS_OF)

    @cached_property
    def stored_models(self) -> dict[str, DataFrame]:
        lists = self.lists
        models = {
            "bridge_company_source": stored(self.bridge),
            "dim_company": stored(self.dim),
            "fct_engagement_ledger": stored(self.ledger),
            "mart_membership_status": stored(self.status),
        }
        parts = (models[n] for n in ("dim_company", "mart_membership_status", "fct_engagement_ledger"))
        models["company_mart"] = stored(mart.company_mart(*parts, AS_OF, lists))
        return models

    @cached_property
    def stored_dim(self) -> DataFrame:
        return stored(self.dim)

    @cached_property
    def stored_mart(self) -> DataFrame:
        """The whole mart as published, for reports that read it and no model below but the dimension."""
        lists, totals = self.lists, self.totals
        return stored(
            mart.company_mart(self.stored_dim, self.status, self.ledger, AS_OF, lists, totals)
        )

    @cached_property
    def reconciled(self) -> tuple[DataFrame, DataFrame]:
        existing = membership.in_period(
            self.sources["mart_membership_detail"], "month_start", AS_OF, "past_current"
        )
        return reconcile.membership_side(self.status), existing

    @cached_property
    def stored_sides(self) -> tuple[DataFrame, DataFrame]:
        """Both sides as published tables are, since digests read them several times."""
        left, right = self.reconciled
        return stored(left), stored(right.select(*left.columns))


def _bridge_lookup(p: Product) -> DataFrame:
    projects = p.sources["stg_bigtime_projects"].select(
        "project_id", F.col("client_id").cast("string").alias("source_company_id")
    )
    return bridge_lookup(projects, p.bridge, C.BIGTIME, "source_company_id")


def _owner_lookup(p: Product) -> DataFrame:
    found = dimension.with_owner(
        p.sources["stg_hubspot_companies"], p.sources["hubspot.company"], p.sources["hubspot.owner"]
    )
    return found.select(
        "company_id", "primary_owner_id", "primary_owner_name", "primary_owner_email"
    )


def _representative_crm(p: Product) -> DataFrame:
    return dimension.representative_crm(
        p.bridge,
        p.sources["stg_hubspot_companies"],
        p.sources["hubspot.company"],
        p.sources["hubspot.owner"],
    )


def _clean_attributes(p: Product) -> DataFrame:
    names = ["company_name", "company_domain", "industry", "property_city", "property_country"]
    return p.sources["stg_hubspot_companies"].select(
        "company_id", *[blank_to_null(F.col(n)).alias(n) for n in names]
    )


def _surrogate_key(p: Product) -> DataFrame:
    return p.sources["int_membership_detail"].select(
        "membership_id",
        surrogate_key(
            F.lit(C.MEMBERSHIP_KEY),
            F.col("membership_id"),
            F.col("assignment_id"),
            F.col("period_start_date"),
            F.col("period_end_date"),
        ).alias("event_key"),
    )


def _deal_status(p: Product) -> DataFrame:
    return p.sources["stg_hubspot_deals"].select(
        "deal_id",
        "deal_status",
        normalise_status(F.col("deal_status"), C.DEAL_STATUSES).alias("engagement_status"),
    )


_ODD_AMOUNT = """CASE CAST(deal_id AS BIGINT) % 7
  WHEN 1 THEN IF(deal_amount > 1e5, CAST('NaN' AS DOUBLE), deal_amount)
  WHEN 2 THEN IF(deal_amount > 1e5, CAST('Infinity' AS DOUBLE), deal_amount)
  WHEN 3 THEN IF(deal_amount > 1e5, CAST('Infinity' AS DOUBLE), CAST('-Infinity' AS DOUBLE))
  WHEN 4 THEN IF(deal_amount > 1e5, 1e20D, -1e20D)
  WHEN 5 THEN 1D / 17179869184D
  WHEN 6 THEN NULL ELSE deal_amount END"""


def _money_totals(p: Product) -> DataFrame:
    """Totals of deals, in buckets that hold NaN, infinite, huge, tiny and missing amounts."""
    deals = p.sources["stg_hubspot_deals"].selectExpr(
        "CAST(deal_id AS BIGINT) % 7 AS bucket", f"{_ODD_AMOUNT} AS odd_amount"
    )
    total = deals.groupBy("bucket").agg(
        exact_sum(F.col("odd_amount")).alias("total"), F.count(F.lit(1)).alias("deals")
    )
    return total.withColumn("total", money_value(F.col("total")))


def _membership_state(p: Product) -> DataFrame:
    columns = [F.col(n) for n in ("membership_status", "period_start_date", "period_end_date")]
    return p.sources["int_membership_detail"].select(
        "membership_id", *columns, membership_state(*columns, AS_OF).alias("engagement_status")
    )


def _distinct_sorted_arrays(p: Product) -> DataFrame:
    """All distinct categories and the 25 smallest plans, members per company."""
    months = p.sources["int_membership_months"]
    whole = months.groupBy("company_id").agg(
        distinct_sorted(F.col("location_id")).alias("location_ids"),
        distinct_sorted(F.col("membership_category")).alias("membership_categories"),
    )
    limited = smallest_distinct(
        months,
        ["company_id"],
        {"first_plan_ids": F.col("plan_id"), "first_member_ids": F.col("member_id")},
        C.PLAN_LIMIT,
    )
    return flat(whole.join(limited, "company_id", "left"))


def _project_events(p: Product) -> DataFrame:
    return ledger.startup_project_events(
        p.sources["hubspot.projects"],
        p.sources["hubspot.projects_to_company"],
        p.sources["hubspot.company"],
        p.bridge,
    )


def _typed_engagements(p: Product) -> DataFrame:
    lists = mart.engagement_lists(p.newest)
    return flat(lists.drop("engagement_timeline", "recent_engagements"))


def _coverage(p: Product) -> DataFrame:
    counts = quality.source_company_counts(
        p.sources["stg_hubspot_deals"],
        p.sources["stg_hubspot_deal_company"],
        p.sources["int_membership_detail"],
        p.sources["stg_bigtime_projects"],
    )
    return quality.mapping_coverage(counts, p.bridge)


def _duplicate_mappings(p: Product) -> DataFrame:
    """The bridge with its review rows handed in a second time."""
    twice = p.bridge.unionByName(p.bridge.where(F.col("requires_manual_review")))
    return quality.duplicate_mappings(twice)


def _duplicate_companies(p: Product) -> DataFrame:
    """The mart with its companies of three systems handed in a second time."""
    rows = p.stored_mart
    return quality.duplicate_companies(rows.unionByName(rows.where("source_system_count = 3")))


def _orphan_links(p: Product) -> DataFrame:
    """Deal links to companies that the CRM part of the bridge does not know."""
    links = p.sources["stg_hubspot_deal_company"]
    known = p.bridge.where(F.col("source_system") == C.HUBSPOT)
    return quality.expect_relationship(links, "company_id", known, "source_company_id")


def _expectation_report(p: Product) -> DataFrame:
    return quality.expectation_report(p.stored_models)


def _row_counts(p: Product) -> DataFrame:
    return quality.row_counts({"company_mart": p.stored_mart, "dim_company": p.stored_dim})


def _month_coverage(p: Product) -> DataFrame:
    future = product.build_status(p.sources, p.bridge, AS_OF, "future")
    return quality.month_coverage({"past_current": p.status, "future": future})


def _current_reconciliation(p: Product) -> DataFrame:
    sides = (membership.in_period(side, "month_start", AS_OF, "current") for side in p.stored_sides)
    return reconcile.reconcile_summary(*sides)


_TOTALS = ("total_source_reported_engagement_amount",) + tuple(
    f"{t}_amount" for t in C.ENGAGEMENT_TYPES
)

QUERIES: dict[str, Callable[[Product], DataFrame]] = {
    # Bridge.
    "bridge_source": lambda p: p.bridge,
    "bridge_lookup": _bridge_lookup,
    # Dimension.
    "id_rollup": lambda p: flat(dimension.id_rollup(p.bridge)),
    "owner_lookup": _owner_lookup,
    "representative_crm": _representative_crm,
    "representative_workspace": lambda p: dimension.representative_workspace(
        p.bridge, p.sources["stg_officernd_companies"]
    ),
    "representative_client": lambda p: dimension.representative_client(
        p.bridge, p.sources["stg_bigtime_clients"]
    ),
    "dim_company": lambda p: flat(p.dim),
    # Ledger.
    "deal_events": lambda p: flat(
        ledger.deal_events(
            p.sources["stg_hubspot_deals"], p.sources["stg_hubspot_deal_company"], p.bridge
        )
    ),
    "project_partners": lambda p: flat(
        ledger.project_partners(
            p.sources["hubspot.projects_to_company"], p.sources["hubspot.company"]
        )
    ),
    "startup_project_events": lambda p: flat(_project_events(p)),
    "membership_events": lambda p: flat(
        ledger.membership_events(p.sources["int_membership_detail"], p.bridge, AS_OF)
    ),
    "services_project_events": lambda p: flat(
        ledger.services_project_events(p.sources["stg_bigtime_projects"], p.bridge)
    ),
    "engagement_ledger": lambda p: flat(p.ledger),
    # Membership.
    "membership_month_rows": lambda p: membership.membership_month_rows(
        p.sources["int_membership_months"], p.bridge, AS_OF
    ),
    "membership_status": lambda p: flat(p.status),
    "membership_status_future": lambda p: flat(
        product.build_status(p.sources, p.bridge, AS_OF, "future")
    ),
    "current_membership": lambda p: flat(membership.current_membership(p.status, AS_OF)),
    "membership_history": lambda p: flat(membership.membership_history(p.status, AS_OF)),
    # Company mart.
    "engagement_counts": lambda p: flat(
        mart.engagement_totals(p.ledger).drop(
            *_TOTALS, "has_engagement_manual_review_mapping", "engagement_min_match_confidence"
        )
    ),
    "engagement_amounts": lambda p: mart.engagement_totals(p.ledger).select(
        KEY, *_TOTALS, "has_engagement_manual_review_mapping", "engagement_min_match_confidence"
    ),
    "money_totals": _money_totals,
    "engagement_timeline": lambda p: unnested(
        mart.engagement_lists(p.newest), "engagement_timeline"
    ),
    "recent_engagements": lambda p: unnested(mart.engagement_lists(p.newest), "recent_engagements"),
    "typed_engagements": _typed_engagements,
    "mapping_quality": lambda p: p.narrow_mart.select(
        KEY,
        "identity_min_match_confidence",
        "min_match_confidence",
        "has_identity_manual_review_mapping",
        "has_any_manual_review_mapping",
    ),
    "membership_status_label": lambda p: p.narrow_mart.select(
        KEY, "membership_status", "has_active_membership", "current_active_memberships"
    ),
    "company_mart": lambda p: flat(p.mart),
    # Scalar rules and arrays.
    "clean_attributes": _clean_attributes,
    "surrogate_key": _surrogate_key,
    "status_normalise_deal": _deal_status,
    "status_normalise_membership": _membership_state,
    "distinct_sorted_arrays": _distinct_sorted_arrays,
    # Expectations.
    "expect_not_null": lambda p: quality.expect_not_null(p.bridge, "requires_manual_review").select(
        "source_system", "source_company_id", KEY
    ),
    "expect_unique": lambda p: quality.expect_unique(p.bridge, [KEY]),
    "expect_unique_combination": lambda p: quality.expect_unique(
        p.bridge, [KEY, "source_system"], nulls="group"
    ),
    "expect_accepted_values": lambda p: quality.expect_accepted(
        p.sources["stg_hubspot_deals"], "deal_status", C.DEAL_STATUSES
    ).select("deal_id", "deal_status"),
    "expect_relationship": _orphan_links,
    "expectation_report": _expectation_report,
    # Reports.
    "qa_duplicate_mappings": _duplicate_mappings,
    "qa_multi_id_groups": lambda p: flat(quality.multi_id_groups(p.bridge)),
    "qa_ledger_null_rates": _coverage,
    "qa_dimension_health": lambda p: quality.dimension_health(p.dim),
    "qa_ledger_coverage": lambda p: quality.ledger_coverage(p.ledger),
    "qa_month_coverage": _month_coverage,
    "reconcile_current_month": _current_reconciliation,
    "reconcile_membership": lambda p: reconcile.full_reconcile(
        *p.reconciled, reconcile.MEMBERSHIP_KEYS, list(reconcile.MEMBERSHIP_MEASURES)
    ),
    "reconcile_mismatches": lambda p: reconcile.reconcile_mismatches(*p.stored_sides),
    "reconcile_summary": lambda p: reconcile.reconcile_summary(*p.stored_sides),
    "smoke_duplicates": _duplicate_companies,
    "smoke_null_counts": lambda p: quality.null_counts(p.narrow_mart, [KEY, "company_name"]),
    "smoke_row_counts": _row_counts,
    "smoke_review_counts": lambda p: quality.review_counts(p.narrow_mart),
    "smoke_status_distribution": lambda p: quality.status_distribution(p.narrow_mart),
    "smoke_engagement_distribution": lambda p: quality.engagement_distribution(p.narrow_mart),
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Product(spark, folder))
