"""Publish models as views or as tables, with descriptions.

A table is replaced as a whole, or partition by partition where these differ. It can be laid out in
buckets, so that joins on the bucket columns move only their other side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entity360.session import stored

VIEW, TABLE = "view", "table"
_SECOND = 1  # makes a second hash of the same columns

# A layer without a setting of its own takes the next one's; the last resort is a view.
LAYER_FALLBACK = {
    "user_mart": ("user_mart", "mart", "data"),
    "mart": ("mart", "data"),
    "fact": ("fact", "data"),
    "dimension": ("dimension", "data"),
    "data": ("data",),
}


def resolve_materialization(settings: Mapping[str, str], layer: str) -> str:
    for name in LAYER_FALLBACK[layer]:
        if name in settings:
            return settings[name]
    return VIEW


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def with_comments(df: DataFrame, column_comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata; unknown columns are an error."""
    unknown = set(column_comments) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    for name, text in column_comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def publish_view(
    spark: SparkSession,
    name: str,
    query: str,
    *,
    namespace: str,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> DataFrame:
    """Publish a query over catalog tables as a view of the catalog, which outlives the session.

    The catalog keeps the text, so it must not name views of the session. Descriptions go into
    the catalog too; those of unknown columns are an error.
    """
    ensure_namespace(spark, namespace)
    df = with_comments(spark.sql(query), column_comments or {})
    described = ", ".join(
        f"`{f.name}`" + (f" COMMENT '{_quoted(f.metadata['comment'])}'" if "comment" in f.metadata else "")
        for f in df.schema.fields
    )
    note = f" COMMENT '{_quoted(comment)}'" if comment else ""
    full = f"`{namespace}`.`{name}`"
    spark.sql(f"CREATE OR REPLACE VIEW {full} ({described}){note} AS {query}")
    return spark.table(full)


class Buckets(NamedTuple):
    """A layout by the hash of columns, sorted within each bucket."""

    number: int
    columns: Sequence[str]


def publish(
    df: DataFrame,
    name: str,
    materialization: str = VIEW,
    *,
    namespace: str | None = None,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    buckets: Buckets | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Publish and return what readers will see.

    A view lives in the session only and is worked out on every read. A table is
    replaced as a whole, and reading it back cuts the lineage, so a lost executor costs
    a re-read instead of a rebuild. A partitioned table is rebalanced on its partition
    columns first: few files per partition, and AQE splits a partition that is too big.
    A bucketed one is dealt by its bucket columns, one file per bucket; that is for columns whose
    values have few rows each, as a bucket is read by one task. ``watch`` sees the rows of a
    table last before they are written.
    """
    spark = df.sparkSession
    df = with_comments(df, column_comments or {})
    if materialization == VIEW:
        if not comment:
            df.createOrReplaceTempView(name)
            return spark.table(name)
        rows = f"{name}_rows"  # only a view that is stated in SQL can carry a comment
        df.createOrReplaceTempView(rows)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW `{name}` COMMENT '{_quoted(comment)}' "
            f"AS SELECT * FROM `{rows}`"
        )
        return spark.table(name)
    if materialization != TABLE:
        raise ValueError(f"materialization must be 'view' or 'table', not {materialization!r}")
    if namespace:
        ensure_namespace(spark, namespace)
    full = f"{namespace}.{name}" if namespace else name
    if partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    elif buckets:
        df = df.repartition(buckets.number, *buckets.columns)
    writer = (watch(df) if watch else df).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns)
    writer.saveAsTable(full)
    if comment:
        spark.sql(f"COMMENT ON TABLE {full} IS '{_quoted(comment)}'")
    return spark.table(full)


def keep_statistics(
    spark: SparkSession, name: str, columns: Sequence[str], *, namespace: str | None = None
) -> None:
    """Keep rows, bytes and the named columns' distinct values, NULLs and bounds in the catalog.

    With ``tune(spark, costs=True)`` sizes are then estimated after filters and joins, so that a side which
    is small only after its filter is broadcast, and one that isn't is not. Name the columns
    of joins and filters only: a scan reads just these. Spark takes the values of a text column to be equally
    frequent, so it underrates a filter on a very frequent one: leave out text columns whose values are
    very unevenly frequent. Spark drops the statistics when the table is
    written again, so they are never stale.
    """
    full = f"`{namespace}`.`{name}`" if namespace else f"`{name}`"
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR COLUMNS {listed}")
    spark.catalog.refreshTable(full)


class Replaced(NamedTuple):
    """What a partition-wise replacement did, as values of the partition column."""

    written: list
    dropped: list
    kept: int


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _digests(df: DataFrame, by: str, tag: str) -> DataFrame:
    """Per partition a digest of its rows that does not depend on their order."""
    columns = sorted(set(df.columns) - {by})
    rows = df.select(
        F.col(by), F.xxhash64(*columns).alias("_one"), F.xxhash64(F.lit(_SECOND), *columns).alias("_two")
    )
    return rows.groupBy(F.col(by).alias(f"{tag}_key")).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("_one").alias("mixed"),
            F.sum(F.col("_two").bitwiseAND(F.lit(0xFFFFFFFF))).alias("added"),
        ).alias(tag)
    )


def replace_partitions(
    df: DataFrame,
    name: str,
    by: str,
    *,
    namespace: str | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> Replaced:
    """Bring a table that ``publish`` partitioned by ``by`` to the rows of ``df``, partition by partition.

    Partitions whose digests agree are left as they are, files included; others are overwritten, and
    those without rows dropped. The rows are stored once, as they are compared and then written, and may
    come from the table itself. The table's columns must be those of ``df``, in any order. Only digests,
    one per partition, come to the driver; the partitions of a table are held there anyway. ``watch`` sees all
    rows, those of unchanged partitions too, last before they are stored.
    """
    spark = df.sparkSession
    full = f"{namespace}.{name}" if namespace else name
    old = spark.table(full)
    if dict(old.dtypes) != dict(df.dtypes):
        raise ValueError(f"{full} has other columns: publish it as a whole")
    rows = stored(watch(df) if watch else df)
    both = _digests(rows, by, "new").join(
        _digests(old, by, "old"), F.col("new_key").eqNullSafe(F.col("old_key")), "full"
    )
    found = both.select(
        F.coalesce("new_key", "old_key").alias("key"),
        F.col("new").isNull().alias("gone"),
        F.col("new").eqNullSafe(F.col("old")).alias("same"),
    ).collect()
    dropped = [r.key for r in found if r.gone]
    changed = [r.key for r in found if not r.gone and not r.same]
    if changed:
        wanted = F.col(by).isin([k for k in changed if k is not None])
        if None in changed:
            wanted = wanted | F.col(by).isNull()
        news = rows.where(wanted).select(*old.columns).hint("rebalance", F.col(by))
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            news.write.insertInto(full, overwrite=True)
    for key in dropped:
        value = "NULL" if key is None else f"'{_quoted(str(key))}'"
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION (`{by}` = {value})")
    spark.catalog.refreshTable(full)
    return Replaced(changed, dropped, len(found) - len(changed) - len(dropped))
