"""Hard negatives by segment summaries: means and deviations bound inner products, in finer and finer segments.

For a segment of L components with means m, m' and deviations d, d', the part of the inner product that lies in it is
within L * (m * m' +- d * d'). A level cuts the vectors into 1, 2, 4, ... segments, and its bounds are sums over
them. The summaries are stored with the vectors, block by block. Pairs that the bounds of one level can't rule out go to
the next one, and those left after the last are scored exactly.

- Positives of an anchor: its best other rows of the same label. A row goes when its upper bound is below the k-th highest
  lower bound.
- Negatives of an anchor and a positive: the best rows of other labels whose score is within given shares of the positive's.
  A row goes when its bounds miss that window, or when k rows are surely inside and above it.

Ties go to the smaller id, a null id last. Rows are identified by their place, so repeated ids do no harm. Rows
with a null label or vector, or with null or non-finite components take no part; for vectors of other lengths and very large
ones see vectors.py. Labels are integers. An empty table, or one without anchors, gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity360.llm import vectors as V
from entity360.llm.common import column, written

DENSE = 0.02  # share of a block's pairs from which bounds are worked out for all of them
SLACK = 1e-9  # of the vectors' lengths: more than rounding can take from a bound
_ROW = {"row": 1, "id": 1, "no_id": 1, "label": 1}


def segments(width: int) -> list[np.ndarray]:
    """Per level the first components of its segments; the finest have two components or three."""
    counts = [1]
    while counts[-1] * 4 <= width:
        counts.append(counts[-1] * 2)
    return [np.linspace(0, width, n + 1).astype(int)[:-1] for n in counts]


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, each times the root of its length."""
    means, deviations = [], []
    values = vectors.astype(np.float64)
    for starts in segments(values.shape[1]):
        lengths = np.diff([*starts, values.shape[1]])
        mean = np.add.reduceat(values, starts, axis=1) / lengths
        apart = values - np.repeat(mean, lengths, axis=1)
        deviation = np.sqrt(np.add.reduceat(apart * apart, starts, axis=1) / lengths)
        means.append(mean * np.sqrt(lengths))
        deviations.append(deviation * np.sqrt(lengths))
    return np.hstack(means), np.hstack(deviations)


def summarised(blocks: DataFrame) -> DataFrame:
    """The blocks with the summaries of their vectors beside them."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [summaries(V.matrix(x, n)) for x, n in zip(batch["vector"], batch["n"], strict=True)]
            yield batch.assign(
                means=[m.tobytes() for m, _ in pairs], deviations=[d.tobytes() for _, d in pairs]
            )

    schema = blocks.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return written(blocks.mapInPandas(add, f"{schema}, means binary, deviations binary"), "summaries")


class _Side:
    """A block with its matrices."""

    def __init__(self, piece: pd.Series, *names: str) -> None:
        self.n = piece["n"]
        self.one = {c: V.matrix(piece[c], self.n)[:, 0] for c in _ROW}
        self.vector = V.matrix(piece["vector"], self.n)
        self.more = {c: V.matrix(piece[c], self.n) for c in names}
        means, deviations = (V.matrix(piece[c], self.n, np.float64) for c in ("means", "deviations"))
        ends = np.cumsum([len(starts) for starts in segments(self.vector.shape[1])])
        self.levels = [
            (means[:, last - n : last], deviations[:, last - n : last])
            for last, n in zip(ends, np.diff([0, *ends]), strict=True)
        ]
        mean, deviation = self.levels[0]
        self.length = np.sqrt(mean * mean + deviation * deviation)[:, 0]


def _summed(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The inner products of rows i of a with rows j of b; all of them at once where that is cheaper."""
    if len(i) > DENSE * len(a) * len(b):
        return (a @ b.T)[i, j]
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 15):
        here = slice(at, at + (1 << 15))
        out[here] = np.einsum("ij,ij->i", a[i[here]], b[j[here]])
    return out


def _bounds(a: _Side, b: _Side, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    (mean_a, dev_a), (mean_b, dev_b) = a.levels[level], b.levels[level]
    middle = _summed(mean_a, mean_b, i, j)
    reach = _summed(dev_a, dev_b, i, j) + SLACK * a.length[i] * b.length[j] + SLACK
    return middle - reach, middle + reach


def _exact(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, in_doubles: bool) -> np.ndarray:
    if len(i) > DENSE * a.n * b.n:
        return V.products(a.vector, b.vector, in_doubles)[i, j]
    return V.pair_products(a.vector, b.vector, i, j)


def _best_of_label(a: _Side, b: _Side, k: int, in_doubles: bool) -> tuple[np.ndarray, ...]:
    """Anchors, rows and scores of the k best rows of each anchor's own label."""
    same = a.one["label"][:, None] == b.one["label"][None, :]
    same[V.own_cells(a.one["row"], b.one["row"])] = False
    i, j = np.nonzero(same)
    for level in range(len(a.levels)):
        low, high = _bounds(a, b, level, i, j)
        keep = high >= V.kth_largest(low, i, k, a.n, -np.inf)[i]
        i, j = i[keep], j[keep]
    score = _exact(a, b, i, j, in_doubles)
    best = V.first_per_owner(i, j, score, k)
    return i[best], j[best], score[best]


def _best_in_windows(
    a: _Side, b: _Side, low: np.ndarray, high: np.ndarray, k: int, in_doubles: bool
) -> tuple[np.ndarray, ...]:
    """Anchors, windows, rows and scores of the k best rows of other labels within each window of each anchor;
    low, high: (anchor, window), low above high where there is none."""
    i, j = np.nonzero(a.one["label"][:, None] != b.one["label"][None, :])
    windows = range(low.shape[1])
    some = low <= high
    top = np.where(some, high, V.LOWEST).max(axis=1)
    bottom = np.where(some, low, -V.LOWEST).min(axis=1)
    widest = np.where(some, high - low, -1).max(axis=1)
    for level in range(len(a.levels)):
        least, most = _bounds(a, b, level, i, j)
        floor = bottom
        narrow = np.flatnonzero(most - least <= widest[i])  # others are surely inside no window
        if len(narrow):
            sure = low.astype(np.float64)
            for w in windows:
                inside = narrow[(least[narrow] >= low[i[narrow], w]) & (most[narrow] <= high[i[narrow], w])]
                best = V.kth_largest(least[inside], i[inside], k, a.n, -np.inf)
                sure[:, w] = np.maximum(sure[:, w], best)
            floor = np.where(some, sure, np.inf).min(axis=1)
        keep = (most >= floor[i]) & (least <= top[i])
        i, j = i[keep], j[keep]
    score = _exact(a, b, i, j, in_doubles)
    fit = (score >= bottom[i]) & (score <= top[i])
    i, j, score = i[fit], j[fit], score[fit]
    found = []
    for w in windows:
        inside = np.flatnonzero((score >= low[i, w]) & (score <= high[i, w]))
        best = inside[V.first_per_owner(i[inside], j[inside], score[inside], k)]
        found.append((i[best], np.full(len(best), w), j[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "no_id", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    anchors: str,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchors: an SQL condition on `id`. least_percent, most_percent: the shares of the positive's score
    that a negative's has.
    """
    label = column(df, label_col).cast("long")
    rows = V.integer_rows(df.where(label.isNotNull()), id_col, vector_col, label=label)
    size = V.size_of(rows)
    asked = written(rows.where(anchors).where("no_id = 0"), "anchors")
    blocks, groups = V.blocks_of(size.rows, V.ROW_BLOCK), V.blocks_of(asked.count(), V.QUERY_BLOCK)
    whole, widths = [(0, size.width)], _ROW | {"vector": size.width}
    stored = summarised(V.packed(rows, blocks, widths, whole))

    def pairs(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = _Side(a.iloc[0]), _Side(b.iloc[0])
        i, j, score = _best_of_label(a, b, positives, size.in_doubles)
        made = {"anchor": a.one["row"][i]} | {c: b.one[c][j] for c in ("row", "id", "no_id")}
        return pd.DataFrame(made | {"score": score})

    sides = V.grid(summarised(V.packed(asked, groups, widths, whole)), groups, stored, blocks)
    found = V.meet(*sides, pairs, "anchor bigint, row bigint, id bigint, no_id bigint, score bigint")
    best = _first(found, positives, "anchor").groupBy(F.col("anchor").alias("row"))
    fields = ("score", "id", "no_id")
    of_anchor = best.agg(
        F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("best")
    ).select(
        "row",
        F.size("best").cast("long").alias("n_best"),
        *[F.col(f"best.{c}").alias(f"best_{c}") for c in fields],
    )
    lists = {f"best_{c}": positives for c in fields} | {"n_best": 1}
    ready = summarised(V.packed(asked.join(of_anchor, "row"), groups, widths | lists, whole))

    def hard(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = _Side(a.iloc[0], *lists), _Side(b.iloc[0])
        score = a.more["best_score"]
        low = -((-score * least_percent) // 100)
        high = np.where(np.arange(positives) < a.more["n_best"], score * most_percent // 100, V.LOWEST)
        i, w, j, found = _best_in_windows(a, b, low, high, negatives, size.in_doubles)
        made = {"anchor": a.one["row"][i], "anchor_id": a.one["id"][i], "place": w}
        made |= {f"positive_{c}": a.more[f"best_{c}"][i, w] for c in fields}
        made |= {c: b.one[c][j] for c in ("row", "id", "no_id")}
        return pd.DataFrame(made | {"score": found})

    longs = ["positive_score", "positive_id", "positive_no_id", "row", "id", "no_id", "score"]
    schema = ", ".join(["anchor bigint", "anchor_id bigint", "place bigint", *[f"{c} bigint" for c in longs]])
    sides = V.grid(ready, groups, stored, blocks)
    return _first(V.meet(*sides, hard, schema), negatives, "anchor", "place").select(
        "anchor_id",
        F.when(F.col("positive_no_id") == 0, F.col("positive_id")).alias("positive_id"),
        "rank",
        F.when(F.col("no_id") == 0, F.col("id")).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
