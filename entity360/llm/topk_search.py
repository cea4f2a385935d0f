"""Exact top-k search by a uniform threshold in three phases.

A vector's components are dealt to parts, and each part keeps the list of its partial scores, so a score is the sum
of one entry of each list.

1. Each part gives every query its k highest partial scores. The rows that these name are scored in full, and a
   query's k-th best of them is a safe cutoff: no row below it is among its k best.
2. The cutoff goes to all parts. A row that reaches it has a share of at least cutoff / parts in some part,
   so each part gives all entries that reach this share.
3. What is known of a row and the share that bounds each missing entry rule most rows out; of the remaining ones the
   missing entries are worked out, and the k best of each block go on to the last ranking.

Queries are rows too and don't find themselves; a copy of a query's row under another row is found. Ties go to
the smaller id, a null id last. Rows are identified by their place, so repeated ids do no harm. Null vectors and vectors with null
or non-finite components take no part; for vectors of other lengths and very large ones see vectors.py. An empty
table, or one without queries, gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity360.llm import vectors as V
from entity360.llm.common import written

PARTS = 2
_ROW = {"row": 1, "id": 1, "no_id": 1}
_FOUND = "query bigint, query_id bigint, row bigint, id bigint, no_id bigint, score bigint"


def nearest(
    df: DataFrame,
    queries: str,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score; queries: an SQL condition on `id`."""
    rows = V.integer_rows(df, id_col, vector_col)
    size = V.size_of(rows)
    asked = written(rows.where(queries).where("no_id = 0"), "queries")
    n_asked = asked.count()
    edges = np.linspace(0, size.width, min(parts, size.width) + 1).astype(int).tolist()
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    blocks, groups = V.blocks_of(size.rows, V.ROW_BLOCK), V.blocks_of(n_asked, V.QUERY_BLOCK)
    lists = V.packed(rows, blocks, _ROW | {"vector": size.width}, spans)

    cutoffs = _cutoffs(asked, groups, rows, lists, blocks, k, spans, size)
    bounded = asked.join(cutoffs, "row", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(V.LOWEST)))
    sent = V.packed(bounded, groups, _ROW | {"cutoff": 1, "vector": size.width}, spans)
    left, right = V.grid(sent, groups, lists, blocks)
    entries = written(_entries(left, right, len(spans), size), "entries")
    found = _resolved(entries, left, right, k, len(spans))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("no_id") == 0, F.col("id")).alias("vec_id"), "score")
    )


def _scores(a: pd.Series, b: pd.Series, in_doubles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scores of a part's queries and rows, LOWEST for a query's own row; and both sides' row numbers."""
    ours, theirs = V.matrix(a["row"], a["n"])[:, 0], V.matrix(b["row"], b["n"])[:, 0]
    out = V.products(V.matrix(a["vector"], a["n"]), V.matrix(b["vector"], b["n"]), in_doubles)
    out[V.own_cells(ours, theirs)] = V.LOWEST
    return out, ours, theirs


def _cutoffs(
    asked: DataFrame,
    groups: int,
    rows: DataFrame,
    lists: DataFrame,
    blocks: int,
    k: int,
    spans: list[tuple[int, int]],
    size: V.Size,
) -> DataFrame:
    """Phase 1. (row, cutoff) of the queries that have k candidates at least."""

    def heads(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        scores, ours, theirs = _scores(a.iloc[0], b.iloc[0], size.in_doubles)
        most = min(k, scores.shape[1])
        least = np.partition(scores, -most, axis=1)[:, -most]
        q, r = np.nonzero((scores >= least[:, None]) & (scores > V.LOWEST))
        best = V.first_per_owner(q, r, scores[q, r], k)
        q, r = q[best], r[best]
        made = {"part": a["part"].iloc[0], "query": ours[q], "row": theirs[r], "score": scores[q, r]}
        return pd.DataFrame(made)

    asked_blocks = V.packed(asked, groups, _ROW | {"vector": size.width}, spans)
    sides = V.grid(asked_blocks, groups, lists, blocks, ["part"])
    local = V.meet(*sides, heads, "part int, query bigint, row bigint, score bigint", ["part"])
    order = Window.partitionBy("query", "part").orderBy(F.desc("score"), "row")
    named = (
        local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "row").distinct()
    )
    full = F.aggregate(
        F.zip_with("mine", "vector", lambda x, y: F.coalesce(x * y, F.lit(0))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    scored = (
        written(named, "named")
        .join(asked.select(F.col("row").alias("query"), F.col("vector").alias("mine")), "query")
        .join(rows.select("row", "vector"), "row")
        .select("query", "row", full.alias("cutoff"))
    )
    place = Window.partitionBy("query").orderBy(F.desc("cutoff"), "row")
    return (
        scored.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") == k)
        .select(F.col("query").alias("row"), "cutoff")
    )


def _entries(left: DataFrame, right: DataFrame, parts: int, size: V.Size) -> DataFrame:
    """Phase 2. Per piece of work and part, the places and scores of the entries that reach their share."""

    def reach(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame | None:
        a, b = a.iloc[0], b.iloc[0]
        scores, _, _ = _scores(a, b, size.in_doubles)
        cutoff = V.matrix(a["cutoff"], a["n"])
        share = -(-cutoff // parts)
        q, r = np.nonzero((scores > V.LOWEST) & (scores >= share))
        if not len(q):
            return None
        made = [q.astype(np.int32), r.astype(np.int32), scores[q, r]]
        return pd.DataFrame(
            [(a["group"], b["block"], a["part"], *[x.tobytes() for x in made])],
            columns=["group", "block", "part", "q", "r", "known"],
        )

    schema = "group int, block int, part int, q binary, r binary, known binary"
    place = ["group", "block", "part"]
    return V.meet(
        left.select(*place, *[c for c in left.columns if c not in place]),
        right.select(*place, *[c for c in right.columns if c not in place]),
        reach,
        schema,
        ["part"],
    )


def _resolved(entries: DataFrame, left: DataFrame, right: DataFrame, k: int, parts: int) -> DataFrame:
    """Phase 3. The k best rows of each piece of work for each query, with their whole scores."""

    def resolve(got: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
        sides = sides.sort_values("part")
        a, b = sides[sides["asks"]], sides[~sides["asks"]]
        n_a, n_b = a["n"].iloc[0], b["n"].iloc[0]
        cells = np.concatenate(
            [
                np.frombuffer(q, np.int32).astype(np.int64) * n_b + np.frombuffer(r, np.int32)
                for q, r in zip(got["q"], got["r"], strict=True)
            ]
        )
        order = np.argsort(cells, kind="stable")
        known = np.concatenate([np.frombuffer(x, np.int64) for x in got["known"]])[order]
        cell, starts, lists = np.unique(cells[order], return_index=True, return_counts=True)
        score = np.add.reduceat(known, starts)
        q, r = cell // n_b, cell % n_b
        cutoff = V.matrix(a["cutoff"].iloc[0], n_a)[:, 0]
        # An entry that was not sent is below cutoff / parts.
        open_ = (lists == parts) | (score * parts >= lists * cutoff[q])
        q, r, score, lists = q[open_], r[open_], score[open_], lists[open_]
        missing = np.flatnonzero(lists < parts)
        score[missing] = sum(
            V.pair_products(V.matrix(x, n_a), V.matrix(y, n_b), q[missing], r[missing])
            for x, y in zip(a["vector"], b["vector"], strict=True)
        )
        best = V.first_per_owner(q, r, score, k)
        q, r, score = q[best], r[best], score[best]

        def taken(side: pd.DataFrame, name: str, n: int, at: np.ndarray) -> np.ndarray:
            return V.matrix(side[name].iloc[0], n)[at, 0]

        return pd.DataFrame(
            {
                "query": taken(a, "row", n_a, q),
                "query_id": taken(a, "id", n_a, q),
                "row": taken(b, "row", n_b, r),
                "id": taken(b, "id", n_b, r),
                "no_id": taken(b, "no_id", n_b, r),
                "score": score,
            }
        )

    names = ["group", "block", "part", "n", *_ROW, "cutoff", "vector"]
    both = left.select(*names, F.lit(True).alias("asks")).unionByName(
        right.withColumn("cutoff", F.lit(None).cast("binary")).select(*names, F.lit(False).alias("asks"))
    )
    return V.meet(entries, both, resolve, _FOUND)
