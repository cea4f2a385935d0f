"""Read a source table and check it against its declared columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from entity360.sources.schemas import SOURCE_SCHEMAS

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIME = (T.TimestampType, T.TimestampNTZType)


class SchemaMismatch(ValueError):
    """A source table lacks a declared column or has it in another type."""


def _fits(actual: T.DataType, declared: T.DataType) -> bool:
    if isinstance(declared, T.LongType):
        return isinstance(actual, _WHOLE)
    if isinstance(declared, T.DoubleType):
        return isinstance(actual, (T.DoubleType, T.FloatType, T.DecimalType, *_WHOLE))
    if isinstance(declared, _TIME):
        return isinstance(actual, _TIME)
    return type(actual) is type(declared)


def conform_source(df: DataFrame, name: str) -> DataFrame:
    """Declared columns only, in declared order; narrower numbers are widened.

    Both timestamp types pass as they are: a warehouse export may carry either.
    """
    actual = {field.name: field.dataType for field in df.schema.fields}
    problems, columns = [], []
    for field in SOURCE_SCHEMAS[name].fields:
        kind = actual.get(field.name)
        if kind is None:
            problems.append(f"{field.name}: missing")
        elif not _fits(kind, field.dataType):
            problems.append(f"{field.name}: {kind.simpleString()}, not {field.dataType.simpleString()}")
        elif kind == field.dataType or isinstance(kind, _TIME):
            columns.append(f"`{field.name}`")
        else:
            columns.append(f"CAST(`{field.name}` AS {field.dataType.simpleString()}) AS `{field.name}`")
    if problems:
        raise SchemaMismatch(f"source {name}: " + "; ".join(problems))
    return df.selectExpr(*columns)


def load_source(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    *,
    table: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """One source from files at ``path`` or from the catalog ``table``."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    raw = spark.table(table) if table else spark.read.format(format).load(path)
    return conform_source(raw, name)


def load_sources(
    spark: SparkSession, locations: Mapping[str, str], *, catalog: bool = False, format: str = "parquet"
) -> dict[str, DataFrame]:
    """Several sources at once: ``{source name: path}``, or table names with ``catalog=True``."""
    return {
        name: load_source(spark, name, table=place)
        if catalog
        else load_source(spark, name, place, format=format)
        for name, place in locations.items()
    }
