"""Hand-made rows that hit the corner cases of every source."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from entity360.sources import SOURCE_SCHEMAS

AS_OF = date(2024, 6, 15)
MAY, JUNE, JULY = date(2024, 5, 1), date(2024, 6, 1), date(2024, 7, 1)


def frame(spark: SparkSession, source: str, rows: list[dict], schema=None) -> DataFrame:
    """Rows of a source; columns left out are NULL."""
    schema = schema or SOURCE_SCHEMAS[source]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in rows], schema)


def link(system, source_id, canonical, review=None, confidence=None, **more):
    return {
        "canonical_company_id": canonical,
        "source_system": system,
        "source_company_id": source_id,
        "requires_manual_review": review,
        "match_confidence": confidence,
        **more,
    }


BRIDGE = [
    link("hubspot", "1", "A", None, 0.9),
    link("hubspot", "2", "A", False, None),
    link("hubspot", "3", "B", True, 0.4),
    link("hubspot", "4", None, True, 0.1),
    link("officernd", "o1", "A", False, 0.8),
    link("officernd", "o2", "C", None, 0.7),
    link("officernd", "o3", None, False, 0.6),
    link("bigtime", "10", "A", False, 0.95),
    link("bigtime", "20", "D", None, None),
]


def bridge(spark, rows=None):
    return frame(spark, "int_cross_source_companies", BRIDGE if rows is None else rows)


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def collect(df, *order):
    return [row.asDict(recursive=True) for row in (df.orderBy(*order) if order else df).collect()]
