"""Reusable DataFrame steps shared by the models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from entity360.sources.schemas import LEDGER_SCHEMA

PERIODS = ("past_current", "current", "future")


def associated(
    df: DataFrame,
    assoc: DataFrame,
    left_key: str,
    right_key: str,
    type_id: int,
    category: str | None = None,
) -> DataFrame:
    """Inner join with the associations of one type (and category); one row per pair."""
    links = assoc.where(F.col("type_id") == type_id)
    if category is not None:
        links = links.where(F.col("category") == category)
    links = links.drop("type_id", "category").withColumnRenamed(right_key, "_link_key")
    return links.join(df, F.col("_link_key") == df[left_key], "inner").drop("_link_key")


def not_deleted(df: DataFrame, flag: str) -> DataFrame:
    """Drop soft-deleted rows; a NULL flag means the row is live."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def first_of_month(day: date) -> date:
    return day.replace(day=1)


def in_period(df: DataFrame, month_col: str, as_of: date, period: str) -> DataFrame:
    """Months relative to the month of ``as_of``. The bound is a literal, so it pushes down."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    month, current = F.col(month_col), F.lit(first_of_month(as_of))
    if period == "past_current":
        return df.where(month <= current)
    if period == "current":
        return df.where(month == current)
    return df.where(month > current)


# The lookup fills these in after the branches are aligned.
RESOLVED = (
    "canonical_company_id",
    "canonical_company_id_is_null",
    "requires_manual_review",
    "match_confidence",
)


def align_events(df: DataFrame, **constants: str) -> DataFrame:
    """Bring one event branch to the ledger columns, without the bridge's four unless it has them.

    ``constants`` become text columns; a column the branch lacks is a typed NULL, or
    a typed empty array.
    """
    present = set(df.columns)
    columns = []
    for field in LEDGER_SCHEMA.fields:
        name, kind = field.name, field.dataType.simpleString()
        if name in RESOLVED and name not in present:
            continue
        if name in constants:
            columns.append(F.lit(constants[name]).alias(name))
            continue
        absent = "array()" if isinstance(field.dataType, T.ArrayType) else "NULL"
        columns.append(F.expr(f"CAST({name if name in present else absent} AS {kind}) AS {name}"))
    return df.select(*columns)


def with_defaults(df: DataFrame, defaults: Mapping[str, bool | int | list]) -> DataFrame:
    """Replace NULLs by typed defaults; an empty list stands for an empty array."""
    columns = []
    for field in df.schema.fields:
        name, kind = field.name, field.dataType.simpleString()
        if name in defaults:
            default = defaults[name]
            text = "array()" if isinstance(default, list) else str(default)
            columns.append(f"coalesce(`{name}`, CAST({text} AS {kind})) AS `{name}`")
        else:
            columns.append(f"`{name}`")
    return df.selectExpr(*columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key. The rank filter runs before the shuffle too (window group limit)."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def smallest_distinct(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], limit: int
) -> DataFrame:
    """Per key, the ``limit`` smallest distinct non-NULL values of each column, ascending.

    Values are de-duplicated on (key, column, value) first, which spreads a hot key
    over its values, and ranked with a group limit, so at most ``limit`` values per
    column are ever collected. A key without any value has no row here.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
            for name, value in columns.items()
        ]
    )
    values = (
        df.select(*keys, F.explode(pairs).alias("pair"))
        .select(*keys, "pair.name", "pair.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    window = Window.partitionBy(*keys, "name").orderBy("value")
    kept = values.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= limit)
    return kept.groupBy(*keys).agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("name") == name, F.col("value")))).alias(name)
            for name in columns
        ]
    )
