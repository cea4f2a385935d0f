"""Vectors as blocks of integer matrices, and a stated set of rows against all rows, block by block.

Each component x becomes floor(256 * x), x as double. Rows whose vector is null or has a null, NaN or
infinite component take no part. Vectors of different lengths are filled up with zeros. Products are exact:
they are worked out in doubles where these hold every sum, else in 64-bit integers; vectors whose products 64 bits
may not hold are an error that says so.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import column, written

SCALE = 256
ROW_BLOCK, QUERY_BLOCK = 2_048, 1_024  # rows and queries that meet in one piece of work
LOWEST = -(1 << 62)  # below every score: of pairs that take no part


def integer_rows(df: DataFrame, id_col: str, vector_col: str, **more: Column) -> DataFrame:
    """Per usable row: row (unique), id, no_id (1 where the id is null, which sorts last), vector, and more."""
    vector = column(df, vector_col)

    def bad(x: Column) -> Column:
        value = x.cast("double")
        return x.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    number = column(df, id_col).cast("long")
    rows = df.where(vector.isNotNull() & ~F.exists(vector, bad)).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(number, F.lit(0)).alias("id"),
        F.when(number.isNull(), 1).otherwise(0).cast("long").alias("no_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"),
        *[value.alias(name) for name, value in more.items()],
    )
    return written(rows, "vectors")


@dataclass(frozen=True)
class Size:
    """Number of rows, length of the longest vector, and the largest absolute component."""

    rows: int
    width: int
    largest: float

    @property
    def in_doubles(self) -> bool:
        return self.width * self.largest**2 < 2**53


def size_of(rows: DataFrame) -> Size:
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    n, width, most = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))
    ).first()
    if width * most**2 >= 2**55:
        raise ValueError(f"products of vectors with components up to {most:g} exceed what 64 bits safely hold")
    return Size(n, max(width, 1), most)


def blocks_of(n: int, size: int) -> int:
    return max(1, -(-n // size))


def packed(
    rows: DataFrame, blocks: int, widths: Mapping[str, int], parts: Sequence[tuple[int, int]]
) -> DataFrame:
    """One row per block and part: the block's rows in the order of their ids, each named column as a matrix of
    64-bit integers in bytes. A part holds a range of the vector's components.

    Rows are dealt by the hash of their number, so that no block outgrows the others.
    """

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["no_id", "id", "row"])
        made = {}
        for name, width in widths.items():
            made[name] = np.zeros((len(rows), width), np.int64)
            for i, value in enumerate(rows[name]):
                value = np.atleast_1d(value)
                made[name][i, : len(value)] = value
        block = rows["block"].iloc[0]
        out = []
        for part, (first, last) in enumerate(parts):
            cells = made | {"vector": np.ascontiguousarray(made["vector"][:, first:last])}
            out.append((block, part, len(rows), *[cells[name].tobytes() for name in widths]))
        return pd.DataFrame(out, columns=["block", "part", "n", *widths])

    dealt = rows.select("row", "id", "no_id", *[c for c in widths if c not in ("row", "id", "no_id")])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    schema = ", ".join(["block int, part int, n int", *[f"`{name}` binary" for name in widths]])
    return written(dealt.groupBy("block").applyInPandas(pack, schema), "blocks")


def matrix(raw: bytes, n: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(raw, dtype=kind).reshape(n, -1)


def grid(
    queries: DataFrame, groups: int, rows: DataFrame, blocks: int, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to the pieces of work (group, block, *keys): each group of queries meets each block."""
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    left = queries.withColumnRenamed("block", "group").select("*", every_block)
    right = rows.select("*", every_group)
    place = ["group", "block", *keys]
    return tuple(side.select(*place, *[c for c in side.columns if c not in place]) for side in (left, right))


def meet(
    queries: DataFrame,
    rows: DataFrame,
    work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame | None],
    schema: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """What `work` makes of each piece of work; one at a time is in memory."""
    place = ["group", "block", *keys]
    names = [field.split()[0] for field in schema.split(", ")]

    def each(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        made = work(a, b) if len(a) and len(b) else None
        return pd.DataFrame(columns=names) if made is None else made

    return queries.groupBy(*place).cogroup(rows.groupBy(*place)).applyInPandas(each, schema)


def products(a: np.ndarray, b: np.ndarray, in_doubles: bool) -> np.ndarray:
    """All inner products of the rows of two integer matrices, as 64-bit integers."""
    if not in_doubles:
        return a @ b.T
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)


def pair_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The inner products of rows i of a with rows j of b."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 15):
        here = slice(at, at + (1 << 15))
        out[here] = np.einsum("ij,ij->i", a[i[here]], b[j[here]])
    return out


def own_cells(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the number of a query is that of a row: the places of both."""
    _, q, r = np.intersect1d(queries, rows, assume_unique=True, return_indices=True)
    return q, r


def kth_largest(values: np.ndarray, owner: np.ndarray, k: int, n: int, least: float) -> np.ndarray:
    """Per owner the k-th largest of its values; `least` where it has fewer."""
    order = np.lexsort((-values, owner))
    starts = np.searchsorted(owner[order], np.arange(n + 1))
    out = np.full(n, least, dtype=values.dtype)
    enough = np.flatnonzero(starts[1:] - starts[:-1] >= k)
    out[enough] = values[order[starts[enough] + k - 1]]
    return out


def first_per_owner(
    owner: np.ndarray, place: np.ndarray, score: np.ndarray, k: int
) -> np.ndarray:
    """Indices of each owner's k highest scores, ties to the smaller place; in that order."""
    order = np.lexsort((place, -score, owner))
    sorted_owner = owner[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_owner, sorted_owner)
    return order[rank < k]
