"""Exact duplicates by two passes over a Bloom filter, with DataFrame functions only.

The first pass sets two bits per row in a filter that remembers which bits were hit at least
twice. The second pass tests every row: a row with a bit that was hit once has no copy and
goes straight to the result, and only the others are shuffled and grouped by their digest.

Texts are equal when they are identical after each run of white space (tab, line feed, vertical
tab, form feed, carriage return, space) became one space. Null counts as empty, and
empty texts are copies of each other. Of a group the smallest id stays; a null id comes after all
others; of rows with the same id and text exactly one stays. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm import bloom
from entity360.llm.common import column, free_name, id_and_text, written

SALTS = 32


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    A group that holds a third of all rows is combined by salt before its totals are formed, and
    its rows find the totals by salt too.
    """
    rows = written(
        id_and_text(df, id_col, text_col).select(
            "id", _digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    bits = bloom.bits_for(rows.count())
    tested = bloom.tested(rows, "digest", bloom.filter_of(rows, "digest", bits, hits=2), bits)
    hexed = F.lower(F.hex("digest")).alias("text_sha256")
    alone = tested.where("NOT __maybe").select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        hexed,
    )
    some = tested.where("__maybe").withColumn("salt", F.pmod("row", F.lit(SALTS)))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    salted = some.groupBy("digest", "salt").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("n")
    )
    totals = salted.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    per_salt = salted.select("digest", "salt").join(totals, "digest")
    grouped = some.join(per_salt, ["digest", "salt"]).select(
        "id",
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("first.row") == F.col("row")).alias("kept"),
        hexed,
    )
    return alone.unionByName(grouped)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One full row of each group of equal texts, with the columns of `df`.

    Rows that the filter proves to be alone don't move. Of the others each task keeps one
    candidate per group before anything is shuffled.
    """
    digest = free_name("__digest", df.columns)
    digests = written(df.select(_digest(column(df, text_col)).alias(digest)), "digests")
    bits = bloom.bits_for(digests.count())
    rows = df.select(
        F.struct(*[column(df, c) for c in df.columns]).alias("whole"),
        F.struct(
            column(df, id_col).isNull().alias("none"), column(df, id_col).alias("id")
        ).alias("order"),
        _digest(column(df, text_col)).alias(digest),
    )
    tested = bloom.tested(rows, digest, bloom.filter_of(digests, digest, bits, hits=2), bits)
    alone = tested.where("NOT __maybe").select("whole.*")
    one = tested.where("__maybe").groupBy(digest).agg(F.min_by("whole", "order").alias("whole"))
    return alone.unionByName(one.select("whole.*"))
