"""Bloom filters of bounded size as a small table of bitmaps, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import free_name

BITS_PER_KEY = 16
BLOCK_BITS = 32_768  # of one bitmap of bitmap_construct_agg
MAX_BITS = 1 << 28  # 32 MB, so a filter may be sent to all executors; beyond, more keys pass it


def bits_for(keys: int) -> int:
    """Bits of a filter: a power of two, 16 per key, within 4 KB and 32 MB."""
    bits = BLOCK_BITS
    while bits < keys * BITS_PER_KEY and bits < MAX_BITS:
        bits *= 2
    return bits


def _positions(key: Column, bits: int) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(bits))


def filter_of(keys: DataFrame, key: str, bits: int, hits: int = 1) -> DataFrame:
    """The filter as (block, bitmap): the bits that at least `hits` rows fell on."""
    return (
        keys.select(F.explode(F.array(*_positions(F.col(key), bits))).alias("position"))
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") >= hits)
        .groupBy(F.floor(F.col("position") / BLOCK_BITS).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("position") % BLOCK_BITS).alias("bitmap"))
    )


def _bit(bitmap: str, position: str) -> Column:
    return F.expr(
        f"coalesce(shiftright(cast(conv(hex(substring({bitmap}, "
        f"cast(({position} % {BLOCK_BITS}) div 8 + 1 AS int), 1)), 16, 10) AS int), "
        f"cast({position} % 8 AS int)) & 1, 0) = 1"
    )


def tested(rows: DataFrame, key: str, bloom: DataFrame, bits: int, flag: str = "__maybe") -> DataFrame:
    """The rows with a boolean `flag`: false where the filter proves the key to be absent.

    flag: no column of `rows`; the other names used on the way give way to those of `rows`.
    """
    small = F.broadcast(bloom)  # at most MAX_BITS
    taken = [*rows.columns, flag]
    position, block, bitmap = ([free_name(f"__{c}{k}", taken) for k in (0, 1)] for c in ("p", "block", "bitmap"))
    out = rows.withColumns(dict(zip(position, _positions(F.col(key), bits), strict=True)))
    for k in (0, 1):
        part = small.select(F.col("block").alias(block[k]), F.col("bitmap").alias(bitmap[k]))
        out = out.join(part, F.floor(F.col(position[k]) / BLOCK_BITS) == F.col(block[k]), "left")
    maybe = _bit(bitmap[0], position[0]) & _bit(bitmap[1], position[1])
    return out.withColumn(flag, maybe).drop(*position, *block, *bitmap)


def split_by(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is surely none of `keys`, and the others; keys: written, column `key`.

    Only the second part has to be shuffled to find out more.
    """
    bits, flag = bits_for(keys.count()), free_name("__maybe", rows.columns)
    marked = tested(rows, key, filter_of(keys, key, bits), bits, flag)
    return marked.where(~F.col(flag)).drop(flag), marked.where(F.col(flag)).drop(flag)
