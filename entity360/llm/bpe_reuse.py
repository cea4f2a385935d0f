"""BPE encoding with chunks that documents share encoded once, and decoding.

A rolling hash over the characters cuts each text into chunks at places that its content
decides, so passages that documents share fall into the same chunks. A chunk that occurs in at least
two texts, or twice in one, is encoded once; its ids are joined to the texts that hold it. Other chunks
are encoded where they are. At each join the ids are repaired: the characters between the last
safe cut before the join and the first one after it are encoded again, and the window grows until the ids on its
left and right agree with those of the chunks. Texts without shared chunks never move; equal texts are
assembled once.

Null counts as the empty text, which has no ids. Texts of any length are encoded whole. A null or
repeated id gives a row as any other. A text with the string of a special token is encoded as a whole,
as that string may cross a join. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm import bloom
from entity360.llm.common import column, slices, written
from entity360.llm.shingles import mixed
from entity360.llm.tokenizer import BATCH_CHARS, BytePairs

WINDOW = 32  # characters that the rolling hash covers
MEAN_CHUNK = 1 << 10  # a power of two
LEAST_CHUNK = 1 << 8
PIECE = 1 << 20  # characters that are hashed at once

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)


def _rolling(points: np.ndarray) -> np.ndarray:
    """A hash of each run of WINDOW characters."""
    n = len(points) - WINDOW + 1
    spread = mixed(points.astype(np.uint64))
    out = np.zeros(n, dtype=np.uint64)
    step = 1
    # Sums over 1, 2, 4, ... characters; each doubles the one before.
    while step < WINDOW:
        spread = spread[: len(spread) - step] * _U(pow(int(_P), step, 1 << 64)) + spread[step:]
        step *= 2
    out[:] = spread[:n]
    return mixed(out)


def cuts(text: str) -> list[int]:
    """Where the chunks of a text start, and its length at the end."""
    found, last = [0], 0
    for at in range(0, max(1, len(text) - WINDOW + 1), PIECE):
        piece = text[at : at + PIECE + WINDOW - 1]
        if len(piece) < WINDOW:
            break
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        hits = np.flatnonzero(_rolling(points) & _U(MEAN_CHUNK - 1) == 0) + at + WINDOW
        for hit in hits.tolist():
            if hit - last >= LEAST_CHUNK and hit < len(text):
                found.append(hit)
                last = hit
    return [*found, len(text)] if text else [0]


def chunks(text: str) -> list[tuple[bytes, str]]:
    """Key and text of each chunk."""
    at = cuts(text)
    parts = [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return [(hashlib.md5(p.encode("utf-8", "surrogatepass")).digest(), p) for p in parts]


def _cut_before(text: str, low: int, high: int) -> int:
    """The last safe cut above `low` that is decided by text[low:high]; else `low`."""
    at = text.rfind(" ", low, high - 1)
    while at > low and text[at + 1].isspace():
        at = text.rfind(" ", low, at)
    return max(at, low)


def _cut_after(text: str, low: int, high: int) -> int:
    """The first safe cut from `low` on that is decided by text[low:high]; else `high`."""
    at = text.find(" ", low, high - 1)
    while at >= 0 and text[at + 1].isspace():
        at = text.find(" ", at + 1, high - 1)
    return at if at >= 0 else high


def joined(text: str, parts: list[tuple[int, int, np.ndarray]], encode: Callable) -> np.ndarray:
    """The ids of a text from those of its parts (start, end, ids)."""
    start, _, ids = parts[0]
    for begin, end, more in parts[1:]:
        low, high = begin, begin
        while True:
            low, high = _cut_before(text, start, low), _cut_after(text, high, end)
            tail, head, window = encode([text[low:begin], text[begin:high], text[low:high]])
            left_agrees = low == start or np.array_equal(ids[len(ids) - len(tail) :], tail)
            right_agrees = high == end or np.array_equal(more[: len(head)], head)
            if left_agrees and right_agrees:
                break
            high = min(end, high + 1)
        kept = ids[: len(ids) - len(tail)] if low > start else ids[:0]
        rest = more[len(head) :] if high < end else more[:0]
        ids = np.concatenate([kept, window, rest])
    return ids


class Reuse:
    """Encodes texts, given the ids of some of their chunks."""

    def __init__(self, pairs: BytePairs) -> None:
        self.pairs = pairs

    def ids(self, text: str, known: dict[bytes, np.ndarray]) -> np.ndarray:
        if any(s in text for s in self.pairs.special):
            return self.pairs.encode([text])[0]
        parts: list[list] = []
        at = 0
        for key, chunk in chunks(text):
            end = at + len(chunk)
            if key in known:
                parts.append([at, end, known[key]])
            elif parts and parts[-1][2] is None:
                parts[-1][1] = end  # neighbours that nobody shares are encoded together
            else:
                parts.append([at, end, None])
            at = end
        if not parts:
            return np.empty(0, dtype=np.uint32)
        fresh = [p for p in parts if p[2] is None]
        for part, ids in zip(fresh, self.pairs.encode([text[a:b] for a, b, _ in fresh]), strict=True):
            part[2] = ids
        return joined(text, [tuple(p) for p in parts], self.pairs.encode)


def _little(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(column(df, text_col), F.lit(""))
    return df.select(column(df, id_col).cast("long").alias("id"), text.alias("text")).withColumn(
        "key", F.unhex(F.md5(F.col("text").cast("binary")))
    )


@dataclass(frozen=True)
class Made:
    """What is made of the ids of a text: columns, and their values for an array of ids."""

    columns: str = "ids binary"
    values: Callable[[np.ndarray], tuple] = lambda ids: (_little(ids),)


def digests(pairs: BytePairs) -> Made:
    """The number of ids, their SHA-256, and that of the text they decode to."""

    def values(ids: np.ndarray) -> tuple:
        again = pairs.decode(ids).encode()
        sha = (hashlib.sha256(x).hexdigest() for x in (_little(ids), again))
        return len(ids), *sha

    return Made("n_tokens bigint, ids_sha256 string, decoded_sha256 string", values)


def encode(
    df: DataFrame,
    pairs: BytePairs | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    made: Made = Made(),  # noqa: B008
) -> DataFrame:
    """Per row: id and the columns of `made`, by default ids as little-endian 32-bit integers."""
    pairs = pairs or BytePairs()
    reuse = Reuse(pairs)
    docs = _keyed(df, id_col, text_col)
    names = [c.split()[0] for c in made.columns.split(", ")]

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [[k for k, _ in chunks(t)] for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "chunks": pd.Series(keys, dtype=object)})

    places = written(
        docs.select("key", "text").mapInPandas(listed, "key binary, chunks array<binary>"), "chunks"
    )
    exploded = places.select("key", F.explode("chunks").alias("chunk"))
    shared = written(
        exploded.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("chunk"),
        "shared",
    )
    held = written(exploded.distinct().join(shared, "chunk"), "held")
    alone, some = bloom.split_by(docs, "key", written(held.select("key").distinct(), "holders"))
    texts = written(some.groupBy("key").agg(F.first("text").alias("text")), "texts")

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_CHARS):
                rows = {k: c for text in part["text"] for k, c in chunks(text)}
                yield pd.DataFrame({"chunk": list(rows), "content": list(rows.values())})

    def encoded_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "content", BATCH_CHARS):
                ids = [_little(x) for x in pairs.encode(part["content"].tolist())]
                yield part[["chunk"]].assign(ids=pd.Series(ids, dtype=object).to_numpy())
        pairs.forget()

    once = written(
        texts.select("text")
        .mapInPandas(cut_up, "chunk binary, content string")
        .groupBy("chunk")
        .agg(F.first("content").alias("content"))
        .join(shared, "chunk")
        .mapInPandas(encoded_chunks, "chunk binary, ids binary"),
        "chunk-ids",
    )
    # The chunks of one text: as many as its length gives.
    known = (
        held.join(once, "chunk")
        .groupBy("key")
        .agg(F.collect_list(F.struct("chunk", "ids")).alias("known"))
    )

    def assembled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_CHARS):
                out = []
                for text, found in zip(part["text"], part["known"], strict=True):
                    ids = {
                        bytes(x["chunk"]): np.frombuffer(x["ids"], dtype="<u4")
                        for x in (found if found is not None else ())
                    }
                    out.append(made.values(reuse.ids(text, ids)))
                yield _with(part[["key"]], names, out)
        pairs.forget()

    def straight(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_CHARS):
                out = [made.values(x) for x in pairs.encode(part["text"].tolist())]
                yield _with(part[["id"]], names, out)
        pairs.forget()

    by_text = written(
        texts.join(known, "key", "left").mapInPandas(assembled, f"key binary, {made.columns}"),
        "by-text",
    )
    moved = some.select("id", "key").join(by_text, "key").drop("key")
    in_place = alone.select("id", "text").mapInPandas(straight, f"id bigint, {made.columns}")
    return in_place.unionByName(moved)


def _with(rows: pd.DataFrame, names: list[str], values: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(values, columns=names, index=rows.index)
    return pd.concat([rows, made], axis=1)


def decode(pairs: BytePairs, ids: Column) -> Column:
    """The text of a binary column of little-endian 32-bit ids."""

    @F.pandas_udf("string")
    def decoded(columns: pd.Series) -> pd.Series:
        return pd.Series([pairs.decode(np.frombuffer(x, dtype="<u4")) for x in columns], dtype=object)

    return decoded(ids)
