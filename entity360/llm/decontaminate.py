"""Benchmark items in training documents: BM25 over an inverted index of the items, searched by
block-max WAND, and word overlap of question and answer to confirm.

The items are indexed; every passage of every document is a query. A passage is a window of words that
overlaps the next one by the length of the longest item, so each copy of an item lies within one. A
score is given as a share of what the item scores for its own text; all items of at least
their least score are retrieved, not a best few. That is LEAST_SCORE, or what a passage that is
confirmed must score if this is less: an item whose rare words all stand in the fifth that a
passage may lack has a lower one. Postings are kept in blocks of items with the
highest share of each term in the block. A term that, with all the terms of less weight, can't lift
any item of the block to its least score is inessential there; a passage is compared with
a block only if its essential terms, at their block's highest shares, can do so.

Of the last sentence of an item the words count as its answer, of the rest as its question. A retrieved
item is confirmed if the passage holds at least OVERLAP of the item's 5-word shingles and of the
words of its answer. Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased; an item of fewer than five words is one shingle.

The index is built for about BLOCK_ITEMS items at a time, so what the driver holds and sends to the executors
has a bound; a larger benchmark is searched in several turns, each of which reads all documents and is done
before the next index is built. Counts of items and words and the mean length are those of the whole
benchmark in every turn, so scores and matches don't depend on the turns. Null and empty texts hold no
item, null and empty items are in no text. Items that repeat a text are each reported. Texts of any length are searched
whole. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import column, free_name, id_and_text, written
from entity360.llm.shingles import NOT_ALNUM, pieces, rolled, sequence_hash, word_hashes

WIDTH = 5
OVERLAP = 0.8
LEAST_SCORE = 0.6
MINOR_SHARE = 0.58  # of the least score that inessential terms may add
BLOCK_ITEMS = 2_000
POSTING_BLOCK = 4
LEAST_STRIDE = 32
K1, B = 1.2, 0.75

_SENTENCE_END = re.compile(r"[.!?]+\s+")


def _words(text: str) -> np.ndarray:
    return word_hashes([text.encode("utf-8", "surrogatepass")], NOT_ALNUM)[0]


def _shingles(words: np.ndarray) -> np.ndarray:
    if len(words) < WIDTH:
        return sequence_hash(words)
    return np.unique(rolled(words, WIDTH))


@dataclass
class Item:
    """A benchmark item: its words, shingles, and the words of its answer."""

    item_id: int
    words: np.ndarray
    shingles: np.ndarray
    question: np.ndarray
    answer: np.ndarray

    @staticmethod
    def of(item_id: int, text: str) -> Item:
        ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
        at = ends[-1] if ends else 0
        words, answer = _words(text), _words(text[at:])
        question = _words(text[:at]) if at else words
        return Item(item_id, words, _shingles(words), np.unique(question), np.unique(answer))


@dataclass
class Statistics:
    """What BM25 needs to know of the whole benchmark: items, mean length, and items per word."""

    items: int
    mean: float
    counts: dict[int, int]

    @staticmethod
    def of(items: list[Item]) -> Statistics:
        counts: dict[int, int] = defaultdict(int)
        for item in items:
            for term in np.unique(item.words).tolist():
                counts[term] += 1
        sizes = [len(i.words) for i in items]
        return Statistics(len(items), float(np.mean(sizes)) if sizes else 0.0, counts)

    def idf(self, term: int) -> float:
        n = self.counts[term]
        return float(np.log(1 + (self.items - n + 0.5) / (n + 0.5)))


def most_lost(item: Item, shares: dict[int, float]) -> float:
    """The highest share of the score that a passage can lack although it is confirmed.

    A word is lost where all runs of WIDTH words over it are, and of these at most 1 - OVERLAP may be, each
    counted once however often it is repeated. A word that stands several times has an equal part of its
    share at each place. The best choice of runs is found from left to right, by the number of runs
    given up and the length of the row of lost ones so far; runs beyond the ends are lost for nothing.
    """
    words = item.words
    if len(words) < WIDTH:
        return 0.0
    runs = rolled(words, WIDTH)
    budget = len(item.shingles) - int(np.ceil(OVERLAP * len(item.shingles) - 1e-9))
    first = np.zeros(len(runs), dtype=bool)
    first[np.unique(runs, return_index=True)[1]] = True
    terms, place, times = np.unique(words, return_inverse=True, return_counts=True)
    gain = (np.array([shares[t] for t in terms.tolist()]) / times)[place]
    lost = np.full((WIDTH + 1, budget + 1), -np.inf)
    lost[WIDTH, :] = 0.0
    for k, value in enumerate(gain.tolist()):
        after = np.full_like(lost, -np.inf)
        given = lost
        if k < len(runs):
            after[0] = lost.max(axis=0)
            if first[k]:
                given = np.hstack([np.full((WIDTH + 1, 1), -np.inf), lost[:, :-1]])
        after[1:WIDTH] = given[: WIDTH - 1]
        after[WIDTH] = np.maximum(given[WIDTH - 1], given[WIDTH]) + value
        lost = after
    return float(max(lost.max(), 0.0))


class Index:
    """Postings of the items' words with their shares of the item's own score, in blocks."""

    def __init__(self, items: list[Item], statistics: Statistics | None = None) -> None:
        self.items = items
        known = statistics or Statistics.of(items)
        #: term -> its items in ascending order with their shares.
        self.postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        essential: set[tuple[int, int]] = set()
        blocks = -(-len(items) // POSTING_BLOCK)
        self.least = np.zeros(len(items))
        self.need = np.full(blocks, np.inf)
        for i, item in enumerate(items):
            terms, times = np.unique(item.words, return_counts=True)
            norm = K1 * (1 - B + B * len(item.words) / known.mean)
            impact = {
                t: known.idf(t) * n * (K1 + 1) / (n + norm)
                for t, n in zip(terms.tolist(), times.tolist(), strict=True)
            }
            own = sum(impact.values())
            shares = {t: value / own for t, value in impact.items()}
            self.least[i] = min(LEAST_SCORE, 1 - most_lost(item, shares))
            block, below, minor = i // POSTING_BLOCK, 0.0, True
            for term, share in sorted(shares.items(), key=lambda x: (x[1], x[0])):
                self.postings[term].append((i, share))
                if minor and below + share < MINOR_SHARE * self.least[i]:
                    below += share
                    continue
                minor = False
                essential.add((term, block))
            self.need[block] = min(self.need[block], self.least[i] - below)
        #: Of each block the lowest of its items' least scores.
        self.least_in = np.minimum.reduceat(self.least, np.arange(0, len(items), POSTING_BLOCK)) if items else self.least
        #: (term, block) -> highest share in it, and where its postings are among those of the term.
        self.highest: dict[tuple[int, int], float] = {}
        self.bounds: dict[tuple[int, int], tuple[int, int]] = {}
        for term, found in self.postings.items():
            for at, (i, share) in enumerate(found):
                key = (term, i // POSTING_BLOCK)
                self.highest[key] = max(self.highest.get(key, 0.0), share)
                self.bounds[key] = (self.bounds.get(key, (at, at))[0], at + 1)
        # Every essential term of one item counts for the whole block.
        pairs = sorted((key, self.highest[key]) for key in essential)
        self.terms = np.array(sorted({t for (t, _), _ in pairs}), dtype=np.uint64)
        at = np.searchsorted(self.terms, np.array([t for (t, _), _ in pairs], dtype=np.uint64))
        self.first = np.searchsorted(at, np.arange(len(self.terms) + 1))
        self.pair_block = np.array([b for (_, b), _ in pairs], dtype=np.int64)
        self.pair_share = np.array([s for _, s in pairs])
        self.stride = max(LEAST_STRIDE, max((len(i.words) for i in items), default=0))

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, block) where the essential terms may lift an item over the threshold.

        Window w has the words from w * stride on, 2 * stride of them.
        """
        if not len(self.terms) or not len(words):
            return
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hits = np.flatnonzero(self.terms[at] == words)
        at = at[hits]
        n = self.first[at + 1] - self.first[at]
        take = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        block, share = self.pair_block[take], self.pair_share[take]
        window = np.repeat(hits // self.stride, n)
        last = len(self.need)
        keys = np.concatenate([window * last + block, (window - 1) * last + block])
        ok = keys >= 0
        keys, place = np.unique(keys[ok], return_inverse=True)
        sums = np.bincount(place, np.concatenate([share, share])[ok])
        for key in keys[sums >= self.need[keys % last] - 1e-9].tolist():
            yield key // last, key % last

    def search(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """Items of a block of at least their least score for a passage: WAND with the block's highest shares."""
        cursors = []
        for term in terms.tolist():
            bounds = self.bounds.get((term, block))
            if bounds is not None:
                cursors.append([self.postings[term][slice(*bounds)], 0, self.highest[term, block]])
        found = []
        least = self.least_in[block] - 1e-9
        while cursors:
            cursors.sort(key=lambda c: c[0][c[1]][0])
            bound, pivot = 0.0, None
            for k, (_, _, high) in enumerate(cursors):
                bound += high
                if bound >= least:
                    pivot = k
                    break
            if pivot is None:
                break
            target = cursors[pivot][0][cursors[pivot][1]][0]
            if cursors[0][0][cursors[0][1]][0] == target:
                score = 0.0
                for cursor in cursors:
                    item, share = cursor[0][cursor[1]]
                    if item != target:
                        break
                    score += share
                    cursor[1] += 1
                if score >= self.least[target] - 1e-9:
                    found.append((target, score))
            else:
                for cursor in cursors[:pivot]:
                    while cursor[1] < len(cursor[0]) and cursor[0][cursor[1]][0] < target:
                        cursor[1] += 1
            cursors = [c for c in cursors if c[1] < len(c[0])]
        return found

    def matches(self, words: np.ndarray) -> dict[int, tuple[float, float, float, float]]:
        """Per confirmed item (by its number): score, and overlap of shingles, question, answer."""
        best: dict[int, tuple[float, float, float, float]] = {}
        for window, block in self.candidates(words):
            passage = words[window * self.stride : (window + 2) * self.stride]
            terms = np.unique(passage)
            for number, score in self.search(terms, block):
                item = self.items[number]
                own = item.shingles
                runs = sequence_runs(passage, len(item.words)) if len(item.words) < WIDTH else rolled(passage, WIDTH)
                overlap = float(np.isin(own, runs).mean())
                answer = float(np.isin(item.answer, terms).mean()) if len(item.answer) else 1.0
                if overlap < OVERLAP or answer < OVERLAP:
                    continue
                question = float(np.isin(item.question, terms).mean())
                best[number] = max(best.get(number, (0.0,) * 4), (score, overlap, question, answer))
        return best


def sequence_runs(words: np.ndarray, n: int) -> np.ndarray:
    """The sequence hash of each run of n words."""
    runs = [sequence_hash(words[i : i + n]) for i in range(len(words) - n + 1)]
    return np.concatenate(runs) if runs else np.empty(0, np.uint64)


def _word_counts(items: DataFrame) -> DataFrame:
    """Per word the number of items that hold it; items: (id, text)."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                yield pd.DataFrame({"term": np.unique(_words(text)).view(np.int64)})

    return items.mapInPandas(distinct, "term bigint").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _item_count(items: DataFrame) -> tuple[int, float]:
    """The number of items that hold a word, and their mean length in words; items: (id, text)."""

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"size": [len(_words(text)) for text in batch["text"]]}, dtype="int64")

    row = items.mapInPandas(sizes, "size bigint").where("size > 0").agg(F.count("size"), F.sum("size")).first()
    return row[0], (row[1] or 0) / max(1, row[0])


def item_rows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The items with a text as (id, text), and the number of turns that they are searched in."""
    rows = items.select(
        column(items, id_col).cast("long").alias("id"), column(items, text_col).alias("text")
    ).where(F.col("text").isNotNull())
    return rows, -(-rows.count() // BLOCK_ITEMS)


def indexes(rows: DataFrame, turns: int) -> Iterator[Index]:
    """Indexes of about BLOCK_ITEMS items each, that together hold all items; rows: (id, text).

    The counts behind the scores are those of all items. Of them, the driver gets only those of
    the words of one turn.
    """
    if turns > 1:
        counts = written(_word_counts(rows), "item-words")
        total, mean = _item_count(rows)
    for turn in range(turns):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(turns)) == turn)
        made = [Item.of(r.id, r.text) for r in part.orderBy("id", "text").collect()]
        made = [i for i in made if len(i.words)]
        if not made:
            continue
        if turns == 1:
            yield Index(made)
            continue
        found = counts.join(_word_counts(part).select("term"), "term").collect()
        yield Index(made, Statistics(total, mean, {r.term % (1 << 64): r.n for r in found}))


def _matches(index: Index, texts: list[str]) -> Iterator[dict]:
    for piece in pieces(texts):
        words, owner = word_hashes(piece, NOT_ALNUM)
        bounds = np.searchsorted(owner, np.arange(len(piece) + 1))
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            yield index.matches(words[first:last])


_LEAKS = "id bigint, item_id bigint, score double, overlap double, question double, answer double"


def _searched(docs: DataFrame, index: Index) -> DataFrame:
    """One row per document and item of the index in it; docs: (id, text)."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].tolist()
            out = [
                (ids[k], index.items[number].item_id, *found)
                for k, matched in enumerate(_matches(index, batch["text"].tolist()))
                for number, found in sorted(matched.items())
            ]
            names = ["id", "item_id", "score", "overlap", "question", "answer"]
            yield pd.DataFrame(out, columns=names).astype({"id": "Int64", "item_id": "Int64"})

    return docs.mapInPandas(search, _LEAKS)


def leaks(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item in it: id, item_id, score, overlap, question, answer."""
    docs = id_and_text(df, id_col, text_col)
    rows, turns = item_rows(items, item_id, item_text)
    parts = []
    for index in indexes(rows, turns):
        found = _searched(docs, index)
        parts.append(found if turns == 1 else written(found, "leaks"))
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], _LEAKS)


def _clean(index: Index) -> Callable[[Column], Column]:
    """A function that tells whether a text holds none of the index's items."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not m for m in _matches(index, texts.fillna("").tolist())], dtype=bool)

    return clean


def drop_leaks(
    df: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents that hold no item, with the columns of `df`.

    One index filters the rows where they are. With several, the rows are written once with a number each,
    and those that a turn finds go by an anti join on it.
    """
    rows, turns = item_rows(items, item_id, item_text)
    if turns <= 1:
        for index in indexes(rows, turns):
            df = df.where(_clean(index)(column(df, text_col)))
        return df
    number = free_name("__row", df.columns)
    numbered = written(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    dirty = leaks(numbered, rows, number, text_col, "id", "text").select(F.col("id").alias(number)).distinct()
    return numbered.join(dirty, number, "left_anti").select(*[column(numbered, c) for c in df.columns])
