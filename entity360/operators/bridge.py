"""Bridge from source-system company ids to canonical ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.functions.exprs import review_flag
from entity360.sources.schemas import BRIDGE_SCHEMA


def bridge_source(mapping: DataFrame) -> DataFrame:
    """The mapping with its published columns; unmapped rows stay in."""
    return mapping.select(*BRIDGE_SCHEMA.fieldNames())


# So many rows of a bridge take some 100 MB in a task that holds them all.
SMALL_ROWS = 500_000


def is_small(bridge: DataFrame, system: str, rows: int = SMALL_ROWS) -> bool:
    """Whether a system's part of the bridge may be sent to every task; FALSE where Spark must broadcast nothing.

    Its rows are counted, up to the limit, as Spark's own estimate goes by the files that lie below.
    """
    if bridge.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    return bridge.where(F.col("source_system") == system).limit(rows + 1).count() <= rows


def bridge_lookup(
    df: DataFrame, bridge: DataFrame, system: str | Column, id_col: str
) -> DataFrame:
    """Left join on (source system, source id).

    Adds the canonical id, whether it is NULL, the review flag (TRUE when unknown) and
    the match confidence. ``system`` is a fixed system name or a column of ``df``.
    The pair must be unique in the bridge, or rows multiply: see ``duplicate_mappings``.
    """
    lookup = bridge.select(
        F.col("source_system").alias("_system"),
        F.col("source_company_id").alias("_id"),
        F.col("canonical_company_id"),
        F.col("requires_manual_review").alias("_review"),
        F.col("match_confidence"),
    )
    if isinstance(system, str):
        lookup = lookup.where(F.col("_system") == system)
        condition = df[id_col] == F.col("_id")
    else:
        condition = (system == F.col("_system")) & (df[id_col] == F.col("_id"))
    joined = df.join(lookup, condition, "left")
    return joined.withColumns(
        {
            "canonical_company_id_is_null": F.col("canonical_company_id").isNull(),
            "requires_manual_review": review_flag(F.col("_review")),
        }
    ).drop("_system", "_id", "_review")
