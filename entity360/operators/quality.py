"""Data-quality checks. Each returns the offending rows (empty means passed) or a report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from entity360 import constants as C
from entity360.functions.exprs import exact_sum, money_value, review_flag
from entity360.operators.relational import associated


# --- Expectations ---------------------------------------------------------------------


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def expect_unique(df: DataFrame, cols: Sequence[str], nulls: str = "skip") -> DataFrame:
    """Keys held by more than one row, with their row count.

    ``nulls="skip"`` leaves out keys with a NULL part; ``nulls="group"`` compares NULLs
    as equal.
    """
    if nulls not in ("skip", "group"):
        raise ValueError(f"nulls must be 'skip' or 'group', not {nulls!r}")
    rows = df.dropna(subset=list(cols)) if nulls == "skip" else df
    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, T.StringType):
        return _repeated_texts(rows, cols[0])
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def _repeated_texts(df: DataFrame, col: str) -> DataFrame:
    """Texts on more than one row, with their row count.

    A text of lower-case hexadecimal digits, as event ids are, is grouped by the bytes that it spells, which
    are half as many to move; any other text by itself. Only one text spells given bytes, so groups are the same.
    """
    text, spelt = F.col(col), F.unhex(F.col(col))
    digits = F.lower(F.hex(spelt)) == text
    groups = df.groupBy(
        F.when(digits, spelt).alias("_bytes"), F.when(~F.coalesce(digits, F.lit(False)), text).alias("_text")
    )
    counted = groups.agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    restored = F.coalesce(F.lower(F.hex("_bytes")), F.col("_text"))
    return counted.select(restored.alias(col), "row_count")


def expect_accepted(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.where(~F.col(col).isin(*values))


def expect_relationship(
    child: DataFrame, col: str, parent: DataFrame, parent_col: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_col).alias("_parent"))
    rows = child.where(F.col(col).isNotNull())
    return rows.join(keys, F.col(col) == F.col("_parent"), "left_anti")


def row_checks(
    not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[Any]] | None = None
) -> list[tuple[str, str, Column]]:
    """(expectation, column, what a failing row fulfils) of all row-wise expectations."""
    checks = [("not_null", col, F.col(col).isNull()) for col in not_null]
    return checks + [
        ("accepted_values", col, ~F.col(col).isin(*values))
        for col, values in (accepted or {}).items()
    ]


class WriteChecks:
    """Row-wise expectations that are counted while a model is written, so they cost no scan.

    ``watch`` the rows that are written, as the last step before the write: a stage that writes
    counts each partition once, however often its tasks are tried. ``rows`` waits for the write.
    """

    def __init__(self, model: str):
        self.model = model
        self.checks = row_checks(NOT_NULL[model], ACCEPTED[model])
        self.seen = Observation(f"checks of {model}")

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(self.checks)]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def row_count(self) -> int:
        return self.seen.get["rows"]

    def rows(self) -> list[tuple[str, str, str, int]]:
        """(model, expectation, column, failing rows)."""
        found = self.seen.get
        return [
            (self.model, kind, col, found[f"c{i}"]) for i, (kind, col, _) in enumerate(self.checks)
        ]


class ExpectationFailed(Exception):
    """What was built does not hold what is expected of it."""


def require_passed(report: Iterable[Sequence[Any]]) -> None:
    """Fail the build if a row (model, expectation, column, failing rows) counts any failure."""
    failed = [f"{m}: {kind}({col}) fails on {n} rows" for m, kind, col, n in report if n]
    if failed:
        raise ExpectationFailed("; ".join(failed))


def check_table(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[Any]] | None = None,
) -> DataFrame:
    """Failing-row counts of all row-wise expectations of a table, in one scan."""
    checks = row_checks(not_null, accepted)
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    entries = [
        F.struct(
            F.lit(kind).alias("expectation"),
            F.lit(col).alias("column_name"),
            F.col(f"c{i}").alias("failing_rows"),
        )
        for i, (kind, col, _) in enumerate(checks)
    ]
    return counts.select(F.lit(model).alias("model_name"), F.inline(F.array(*entries)))


def _failures(found: DataFrame, model: str, kind: str, columns: str) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(model).alias("model_name"),
        F.lit(kind).alias("expectation"),
        F.lit(columns).alias("column_name"),
        "failing_rows",
    )


# Expectations of the five models.
NOT_NULL = {
    "bridge_company_source": ("source_system", "source_company_id", "requires_manual_review"),
    "dim_company": ("canonical_company_id", "source_system_count", "has_manual_review_mapping"),
    "fct_engagement_ledger": (
        "engagement_event_id",
        "canonical_company_id_is_null",
        "source_company_id",
        "source_system",
        "engagement_category",
        "engagement_type",
        "source_engagement_id",
        "requires_manual_review",
    ),
    "mart_membership_status": (
        "month_start",
        "canonical_company_id_is_null",
        "officernd_company_id",
        "location_id",
        "membership_category",
        "plan_id",
        "active_memberships",
        "active_members",
        "total_mrr",
        "total_calculated_list_price",
        "total_calculated_discount_amount",
        "has_manual_review_mapping",
    ),
    "company_mart": (
        "canonical_company_id",
        "source_system_count",
        "is_multi_source_company",
        "has_identity_manual_review_mapping",
        "has_any_manual_review_mapping",
        "membership_status",
        "has_active_membership",
        "current_active_memberships",
        "current_active_members",
        "current_total_mrr",
        "has_engagement",
        "has_deal_engagement",
        "has_membership_engagement",
        "has_project_engagement",
        "total_engagement_count",
    ),
}
_FLAG = (True, False)
ACCEPTED = {
    "bridge_company_source": {"source_system": C.SYSTEMS},
    "dim_company": {"company_name_source": C.SYSTEMS},
    "fct_engagement_ledger": {
        "source_system": C.SYSTEMS,
        "engagement_category": (C.BUSINESS,),
        "engagement_type": C.ENGAGEMENT_TYPES,
    },
    "mart_membership_status": {},
    "company_mart": {
        "company_name_source": C.SYSTEMS,
        "membership_status": (C.ACTIVE_MEMBER, C.FORMER_MEMBER, C.NO_MEMBERSHIP),
        "is_multi_source_company": _FLAG,
        "has_identity_manual_review_mapping": _FLAG,
        "has_any_manual_review_mapping": _FLAG,
        "has_active_membership": _FLAG,
        "has_engagement": _FLAG,
        "has_deal_engagement": _FLAG,
        "has_membership_engagement": _FLAG,
        "has_project_engagement": _FLAG,
    },
}
UNIQUE = {
    "dim_company": ("canonical_company_id",),
    "fct_engagement_ledger": ("engagement_event_id",),
    "company_mart": ("canonical_company_id",),
}
UNIQUE_COMBINATION = {
    "bridge_company_source": ("canonical_company_id", "source_system", "source_company_id"),
    "dim_company": ("canonical_company_id",),
    "mart_membership_status": (
        "month_start",
        "officernd_company_id",
        "location_id",
        "membership_category",
        "plan_id",
    ),
}
# Models whose canonical id must exist in the dimension.
RELATED = (
    "bridge_company_source",
    "fct_engagement_ledger",
    "mart_membership_status",
    "company_mart",
)


def expectation_report(
    models: Mapping[str, DataFrame], checked: Iterable[str] = ()
) -> DataFrame | None:
    """Failing-row counts of all expectations, for the models given by name.

    Row-wise checks take one scan per model, and none for the models in ``checked``, which were
    watched as they were written; only uniqueness and relationships shuffle. Relationship
    checks need ``dim_company`` among the models. None if there is nothing to check.
    """
    parts, checked = [], set(checked)
    for model, df in models.items():
        if model not in checked:
            parts.append(check_table(df, model, NOT_NULL[model], ACCEPTED[model]))
        if model in UNIQUE:
            found = expect_unique(df, UNIQUE[model])
            parts.append(_failures(found, model, "unique", ", ".join(UNIQUE[model])))
        if model in UNIQUE_COMBINATION:
            cols = UNIQUE_COMBINATION[model]
            found = expect_unique(df, cols, nulls="group")
            parts.append(_failures(found, model, "unique_combination", ", ".join(cols)))
        if model in RELATED and "dim_company" in models:
            key = "canonical_company_id"
            found = expect_relationship(df.select(key), key, models["dim_company"], key)
            parts.append(_failures(found, model, "relationship", key))
    return reduce(DataFrame.unionByName, parts) if parts else None


# --- Bridge and coverage reports ------------------------------------------------------


def duplicate_mappings(bridge: DataFrame, limit: int = C.REPORT_LIMIT) -> DataFrame:
    """(system, source id) pairs mapped more than once, most copies first."""
    pairs = ["source_system", "source_company_id"]
    return (
        expect_unique(bridge, pairs, nulls="group")
        .orderBy(F.col("row_count").desc(), *[F.col(c).asc_nulls_first() for c in pairs])
        .limit(limit)
    )


def multi_id_groups(bridge: DataFrame, limit: int = C.REPORT_LIMIT) -> DataFrame:
    """Companies with several ids in one system, most ids first, with sample ids.

    The bridge is reduced once to its ids per company and system. The groups' totals and their
    smallest ids both come from that: a group limit leaves few ids per group before
    anything is gathered, so neither a busy company nor the NULL one is gathered whole. A NULL
    canonical id forms a group of its own.
    """
    keys = ["canonical_company_id", "source_system"]
    item = ("source_company_id", "review_rows", "confidence")
    ids = bridge.groupBy(*keys, "source_company_id").agg(
        F.count_if("requires_manual_review").alias("review_rows"),
        F.min("match_confidence").alias("confidence"),
    )
    order = (
        F.col("source_company_id_count").desc(),
        F.col("canonical_company_id").asc_nulls_first(),
        F.col("source_system").asc_nulls_first(),
    )
    top = (
        ids.groupBy(*keys)
        .agg(
            F.count("source_company_id").alias("source_company_id_count"),
            F.sum("review_rows").alias("manual_review_rows"),
            F.min("confidence").alias("min_match_confidence"),
        )
        .where("source_company_id_count > 1")
        .orderBy(*order)
        .limit(limit)
    )
    window = Window.partitionBy(*keys).orderBy(F.col("source_company_id").asc_nulls_last())
    samples = (
        ids.withColumn("_row", F.row_number().over(window))
        .where((F.col("_row") <= C.SAMPLE_ID_LIMIT) & F.col("source_company_id").isNotNull())
        .groupBy(*[F.col(c).alias(f"_{c}") for c in keys])
        .agg(F.sort_array(F.collect_list(F.struct(*item))).alias("_samples"))
    )
    # NULL keys must meet each other, so every key part joins null-safe.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return (
        top.join(samples, reduce(lambda a, b: a & b, same), "left")
        .select(
            *keys,
            "source_company_id_count",
            F.col("_samples.source_company_id").alias("sample_source_company_ids"),
            "manual_review_rows",
            "min_match_confidence",
        )
        .orderBy(*order)
    )


def source_company_counts(
    deals: DataFrame, assoc: DataFrame, detail: DataFrame, services_projects: DataFrame
) -> DataFrame:
    """Event rows per source company of the three systems that report coverage."""
    primary = associated(
        deals.select("deal_id"),
        assoc,
        "deal_id",
        "deal_id",
        C.PRIMARY_COMPANY_TYPE,
        C.PRIMARY_COMPANY_CATEGORY,
    )
    sides = {
        C.HUBSPOT: primary.select("company_id"),
        C.OFFICERND: detail.select("company_id"),
        C.BIGTIME: services_projects.select(F.col("client_id").cast("string").alias("company_id")),
    }
    counted = [
        df.groupBy(F.lit(system).alias("source_system"), F.col("company_id").alias("source_company_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        for system, df in sides.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def mapping_coverage(counts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Rows, unmapped rows and their share, and review rows per source system.

    The counts per source company are joined, not the events, so a busy company is
    one row in the join.
    """
    lookup = bridge.select(
        F.col("source_system").alias("_system"),
        F.col("source_company_id").alias("_id"),
        "canonical_company_id",
        "requires_manual_review",
    )
    pair = (F.col("_system") == F.col("source_system")) & (F.col("_id") == F.col("source_company_id"))
    unmapped = F.when(F.col("canonical_company_id").isNull(), F.col("n")).otherwise(F.lit(0))
    review = F.when(review_flag(F.col("requires_manual_review")), F.col("n")).otherwise(F.lit(0))
    return (
        counts.join(lookup, pair, "left")
        .groupBy("source_system")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(unmapped).alias("null_canonical_rows"),
            F.try_divide(F.sum(unmapped), F.sum("n")).alias("null_canonical_rate"),
            F.sum(review).alias("manual_review_rows"),
        )
        .orderBy(F.col("row_count").desc())
    )


def _coverage(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, unmapped rows and their share per key."""
    unmapped = F.count_if(F.col("canonical_company_id").isNull())
    rows = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        rows.alias("row_count"),
        unmapped.alias("null_canonical_rows"),
        F.try_divide(unmapped, rows).alias("null_canonical_rate"),
        F.count_if(review_flag(F.col("requires_manual_review"))).alias("manual_review_rows"),
    )


def ledger_coverage(ledger: DataFrame) -> DataFrame:
    """Mapping coverage of the built ledger by source system and engagement type."""
    return _coverage(ledger, "source_system", "engagement_type")


def month_coverage(statuses: Mapping[str, DataFrame]) -> DataFrame:
    """Mapping coverage of the membership rows of each period."""
    parts = [
        status.select(
            F.lit(period).alias("period"),
            "canonical_company_id",
            F.col("has_manual_review_mapping").alias("requires_manual_review"),
        )
        for period, status in statuses.items()
    ]
    return _coverage(reduce(DataFrame.unionByName, parts), "period")


def dimension_health(dim: DataFrame) -> DataFrame:
    """One row on the dimension: its size, missing ids and names, reviews and sources."""
    return dim.agg(
        F.count(F.lit(1)).alias("company_count"),
        F.count_if(F.col("canonical_company_id").isNull()).alias("null_id_count"),
        F.count_if(F.coalesce(F.col("company_name"), F.lit("")) == "").alias("blank_name_count"),
        F.count_if("has_manual_review_mapping").alias("manual_review_count"),
        F.count_if(F.col("source_system_count") > 1).alias("multi_source_count"),
    )


# --- Smoke reports on the company mart ------------------------------------------------


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in cols])


def row_counts(models: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model_name"), "row_count"
        )
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def duplicate_companies(mart: DataFrame, limit: int = C.REPORT_LIMIT) -> DataFrame:
    """Company ids with more than one row; a NULL id counts like any other."""
    return (
        expect_unique(mart, ["canonical_company_id"], nulls="group")
        .orderBy(F.col("row_count").desc(), F.col("canonical_company_id").asc_nulls_first())
        .limit(limit)
    )


def review_counts(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count_if("has_any_manual_review_mapping").alias("manual_review_company_count"),
        F.count_if("has_identity_manual_review_mapping").alias(
            "identity_manual_review_company_count"
        ),
    )


def status_distribution(mart: DataFrame) -> DataFrame:
    """Companies and current-month totals per membership status."""
    revenue = money_value(exact_sum(F.col("current_total_mrr")), 2)
    return (
        mart.groupBy("membership_status")
        .agg(
            F.count(F.lit(1)).alias("company_count"),
            F.sum("current_active_memberships").alias("current_active_memberships"),
            F.sum("current_active_members").alias("current_active_members"),
            revenue.alias("current_total_mrr"),
        )
        .orderBy(F.col("company_count").desc())
    )


def engagement_distribution(mart: DataFrame) -> DataFrame:
    """Companies and events per engagement type: one aggregate, then turned into rows."""
    totals = mart.agg(
        *[F.count_if(f"has_{t}_engagement").alias(f"{t}_companies") for t in C.ENGAGEMENT_TYPES],
        *[F.sum(f"{t}_engagement_count").alias(f"{t}_events") for t in C.ENGAGEMENT_TYPES],
    )
    rows = [
        F.struct(
            F.lit(t).alias("engagement_type"),
            F.col(f"{t}_companies").alias("companies_with_engagement_type"),
            F.col(f"{t}_events").alias("engagement_count"),
        )
        for t in C.ENGAGEMENT_TYPES
    ]
    return totals.select(F.inline(F.array(*rows)))
