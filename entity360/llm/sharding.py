"""Shards of near equal bytes by sampled splitters, with DataFrame functions only.

A sample of keys, drawn with a chance in proportion to the size of a record, gives quantile
boundaries that cut the key space into many small ranges. The exact bytes of each range are summed;
ranges that came out overfull are sampled again, more densely, and cut once more, until none is or all
further cuts would split a row. Shard boundaries then fall at exact byte positions within a few ranges, found by a running sum inside each.

The key is (hash of the text, id, number of the row), so copies stand side by side and a text that holds a
third of all rows is still cut by id, and rows that repeat text and id, or have no id, by their number. A group of copies that a shard boundary would cut stays whole if it is at
most `whole_share` of a shard; a larger group is cut where the bytes say, because the law
is near equal bytes. Null texts have no bytes and the checksum of the empty text; a null id sorts
first; repeated rows each get a slot; an empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entity360.llm.common import id_and_text, written

RECORD_BYTES = 16
SAMPLES_PER_SHARD = 256  # keys drawn; the sample doesn't grow with the data
RANGES_PER_SHARD = 32
OVERFULL = 2.0  # times the mean bytes of a range
WHOLE_SHARE = 0.01

Key = tuple[int, int, int]


def _drawn(rows: DataFrame, rate: float, seed: int) -> DataFrame:
    """Keys drawn with a chance of size * rate, the same ones on every run."""
    lot = F.pmod(F.xxhash64("h", "k", "row", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(lot < F.col("size") * rate).select("h", "k", "row")


def _range_of(splitters: list[Key]) -> Column:
    """The number of splitters that are not above the key (h, k, row), by binary search."""
    if not splitters:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(splitters):
        steps.insert(0, step)
        step *= 2
    listed = lambda i: "array(" + ",".join(f"cast('{s[i]}' AS long)" for s in splitters) + ")"
    at = "lo + step - 1"
    sh, sk, sr = (f"get({listed(i)}, {at})" for i in range(3))
    return F.expr(
        f"aggregate(array({','.join(map(str, steps))}), 0, (lo, step) -> "
        f"if({sh} < h OR ({sh} = h AND ({sk} < k OR ({sk} = k AND {sr} <= row))), lo + step, lo))"
    )


def splitters_for(rows: DataFrame, total: int, shards: int) -> list[Key]:
    """Boundaries of the key ranges; their number depends on `shards` alone.

    rows: (h, k, size, row). The sample has SAMPLES_PER_SHARD * shards keys on average, and each
    further round draws as many at most, from the overfull ranges only.
    """
    n = shards * SAMPLES_PER_SHARD
    keep_each = SAMPLES_PER_SHARD // RANGES_PER_SHARD
    keys = sorted((r.h, r.k, r.row) for r in _drawn(rows, n / total, 0).collect())
    splitters = sorted(set(keys[keep_each - 1 :: keep_each]))
    fair = total / (shards * RANGES_PER_SHARD)
    for turn in count(1):
        ranged = rows.withColumn("range", _range_of(splitters))
        over = [
            (r.range, r.bytes)
            for r in ranged.groupBy("range")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            .where((F.col("bytes") > OVERFULL * fair) & (F.col("n") > 1))
            .collect()
        ]
        if not over:
            break
        dense = min(1.0, n / sum(b for _, b in over) / 2)
        inside = ranged.where(F.col("range").isin([r for r, _ in over]))
        drawn = sorted((r.h, r.k, r.row) for r in _drawn(inside, dense, turn).collect())
        each = max(1, int(dense * fair))
        more = sorted(set(splitters) | set(drawn[each - 1 :: each]))
        if len(more) == len(splitters):
            break
        splitters = more
    return splitters


def shard_by_bytes(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_share: float = WHOLE_SHARE,
) -> DataFrame:
    """Per row: id, size, text_crc32, shard (from 0) and slot (from 0 in each shard, no gaps)."""
    rows = written(
        id_and_text(df, id_col, text_col).select(
            "id",
            (F.octet_length("text") + RECORD_BYTES).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("h"),
            F.coalesce(F.col("id"), F.lit(-(1 << 63))).alias("k"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size")).first()[0] or 1
    ranged = rows.withColumn("range", _range_of(splitters_for(rows, total, shards)))
    # One row per range, a few thousand at most: one task may add them up, and all may hold them.
    ordered = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(ordered), F.lit(0)).alias("byte_start"),
            F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("row_start"),
        )
    )
    inside = W.partitionBy("range").orderBy("h", "k", "row")
    before = F.coalesce(
        F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    placed = written(
        ranged.withColumns({"before": before, "nth": F.row_number().over(inside) - 1})
        .join(F.broadcast(starts), "range")
        .select(
            "id",
            "size",
            "text_crc32",
            "h",
            (F.col("byte_start") + F.col("before")).alias("at"),
            (F.col("row_start") + F.col("nth")).alias("position"),
        ),
        "placed",
    )
    by_bytes = lambda at: F.least(
        F.floor(at.cast("decimal(38,0)") * shards / F.lit(total)).cast("int"), F.lit(shards - 1)
    )
    # Each such group holds a shard boundary, so there are fewer than `shards` of them.
    snapped = (
        placed.groupBy("h")
        .agg(F.min("at").alias("start"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & (F.col("bytes") <= whole_share * total / shards))
        .where(by_bytes(F.col("start")) != by_bytes(F.col("start") + F.col("bytes") - 1))
        .select("h", by_bytes(F.col("start") + F.floor(F.col("bytes") / 2)).alias("whole"))
    )
    sharded = placed.join(F.broadcast(snapped), "h", "left").withColumn(
        "shard", F.coalesce("whole", by_bytes(F.col("at")))
    )
    first = sharded.groupBy("shard").agg(F.min("position").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(
        "id",
        "size",
        "text_crc32",
        "shard",
        (F.col("position") - F.col("first")).cast("long").alias("slot"),
    )
