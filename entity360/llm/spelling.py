"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted over all texts first; the vocabulary, not the text, is searched for near words. Two words that are one
inserted, deleted or replaced character apart share the first or the last p characters, p being half the length of the
shorter one. So words meet by (length, side, those characters), each under its own length and as the longer one under the
length below. Such groups are dealt into buckets, and a bucket's words of one length and side make one index.

The index holds for each position and letter the set of words with that letter there, as bits. A word that looks
for its near ones runs over its letters once and carries four sets in machine words: no error so far, one letter
replaced, one more letter in the found word (positions shifted up), one letter less (shifted down). Each step is a few
bitwise operations on 64 words at a time, for many looking words at once. A group of more than HOT words is
dealt into blocks, and each of its words looks through all of them.

Only sums leave a piece of work: how many near words were found, and the most frequent of them. A pair that shares both
ends is counted by its first ones.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Null and empty texts have none. Repeated rows
count each. A null id counts as an empty one where ids decide on changes. Long texts are cut between
words. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import column, written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 5, 3
BUCKET = 1 << 14  # looking words of a piece of work, about
HOT = 1 << 14  # words that share one end; more of them are dealt into blocks of this size
LOOKING = 256  # words that run over the index together
PIECE = 1 << 20  # characters of a text that are read at once
FLUSH = 200_000  # distinct words that a task counts before it hands them on

_RUN = re.compile(f"[{LETTERS}]+")
_OTHER = re.compile(f"[^{LETTERS}]")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}



class Crc:
    """crc32 of `<prefix><word>` for many words, from the words' own: for texts of equal length crc32 is linear but for a
    constant."""

    def __init__(self, prefix: bytes, longest: int) -> None:
        zeros = [bytes(n) for n in range(longest + 1)]
        start = zlib.crc32(prefix)
        self.of_length = np.array([zlib.crc32(z, start) ^ zlib.crc32(z) for z in zeros], np.int64)

    def of(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.of_length[lengths] ^ crcs


class Tally(dict):
    """Numbers of words, given as they come, with the count, crc32 and length in bytes of each."""

    def __init__(self) -> None:
        self.crcs, self.lengths, self.longest = array("q"), array("q"), 0
        self.counts = np.zeros(1 << 12, np.int64)

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        self.crcs.append(zlib.crc32(raw))
        self.lengths.append(len(raw))
        self.longest = max(self.longest, len(raw))
        number = self[word] = len(self)
        if number == len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        return number

    def add(self, words: list[str], doc: str, every: int | None) -> None:
        """Counts the words of a document; `every`: see spelling_groups."""
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        found, times = np.unique(numbers, return_counts=True)
        if every:
            lengths = np.frombuffer(self.lengths, np.int64)[found]
            crcs = np.frombuffer(self.crcs, np.int64)[found]
            prefix = Crc(f"{doc}:".encode(), int(lengths.max(initial=0)))
            hashes = prefix.of(crcs, lengths)
            hit = hashes % every == 0
            if hit.any():
                word_of = dict(zip(numbers.tolist(), words, strict=True))
                for number, h, n in zip(found[hit].tolist(), hashes[hit].tolist(), times[hit].tolist(), strict=True):
                    word = word_of[number]
                    at = h % len(word)
                    less = self[word[:at] + word[at + 1 :]]  # may put a longer array into its place
                    self.counts[less] += n
                found, times = found[~hit], times[~hit]
        self.counts[found] += times

    def frame(self) -> pd.DataFrame:
        counts = self.counts[: len(self)]
        words = np.array(list(self), dtype=object)  # plain objects: a chunked text column can't be sent
        return pd.DataFrame({"word": pd.Series(words[counts > 0], dtype=object), "n": counts[counts > 0]})


def _words(text: str) -> Iterator[list[str]]:
    """The words of a text, in lists that pieces of it hold; a longer run of letters is in one piece."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = _OTHER.search(text, end)
            end = cut.start() if cut else len(text)
        if words := _RUN.findall(text[at:end].translate(_LOWER)):
            yield words
        at = end


def word_counts(df: DataFrame, id_col: str, text_col: str, drop_every: int | None = None) -> DataFrame:
    """(word, n) of all words of all texts, however short or rare; drop_every: see spelling_groups."""
    texts = df.select(
        F.coalesce(column(df, id_col).cast("string"), F.lit("")).alias("id"), column(df, text_col).alias("text")
    ).where("text IS NOT NULL")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                for words in _words(text):
                    tally.add(words, doc, drop_every)
                if len(tally) > FLUSH:
                    yield tally.frame()
                    tally = Tally()
        yield tally.frame()

    return texts.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def meeting_places(words: DataFrame) -> DataFrame:
    """(bucket, block, length, side, ends, word, n, own): where each word looks and, if `own`, is indexed."""
    place = """
        explode(array(
            named_struct('length', size, 'side', 'first', 'ends', left(word, size div 2)),
            named_struct('length', size, 'side', 'last', 'ends', right(word, size div 2)),
            named_struct('length', size - 1, 'side', 'first', 'ends', left(word, (size - 1) div 2)),
            named_struct('length', size - 1, 'side', 'last', 'ends', right(word, (size - 1) div 2))
        ))
    """
    placed = words.withColumn("size", F.char_length("word")).withColumn("place", F.expr(place))
    rows = placed.select("word", "n", "place.*")
    keys = ["length", "side", "ends"]
    buckets = -(-words.count() * 4 // BUCKET) or 1
    # At most as many as there are words, over HOT / 4.
    hot = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("there")).where(F.col("there") > HOT), "hot")
    blocks = F.ceil(F.col("there") / HOT).cast("int")
    home = F.pmod(F.xxhash64("word"), blocks).cast("int")
    return (
        rows.join(hot, keys, "left")
        .withColumn("block", F.explode(F.coalesce(F.sequence(F.lit(1), blocks), F.array(F.lit(0)))))
        .select(
            F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
            "block",
            *keys,
            "word",
            "n",
            F.coalesce(home + 1 == F.col("block"), F.lit(True)).alias("own"),
        )
    )


def _letters(words: list[str], length: int) -> np.ndarray:
    """The code points, one row per word; 0 beyond its end."""
    return np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length)


class PositionIndex:
    """For each position and letter the words with that letter there, as bits; for each length the words of it."""

    def __init__(self, words: list[str]) -> None:
        self.size = len(words)
        lengths = np.array([len(w) for w in words])
        letters = _letters(words, int(lengths.max()))
        self.alphabet = np.unique(letters[letters > 0])
        # Row 0 is the empty set, for letters that no word has.
        self.sets = [
            self._bits(np.concatenate([[np.zeros(self.size, bool)], self.alphabet[:, None] == at])) for at in letters.T
        ]
        self.none = self.sets[0][0]
        self.of_length = {int(n): self._bits(lengths == n) for n in np.unique(lengths)}

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        raw = np.packbits(flags, axis=-1, bitorder="little")
        pad = [(0, 0)] * (flags.ndim - 1) + [(0, -raw.shape[-1] % 8)]
        return np.pad(raw, pad).view(np.uint64)

    def _at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Per letter the set of words with it at a position."""
        if 0 <= position < len(self.sets):
            return self.sets[position][letters]
        return np.broadcast_to(self.none, (len(letters), len(self.none)))

    def one_edit(self, words: list[str], shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of numbers: of the given words, all of one length, and of the index's words that are one edit from them
        and have `shift` letters more (-1, 0 or 1)."""
        length = len(words[0])
        wanted = self.of_length.get(length + shift)
        if wanted is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        letters = _letters(words, length)
        at = np.searchsorted(self.alphabet, letters)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == letters
        codes = np.where(known, at + 1, 0).T
        found = [
            self._run(codes[:, first : first + LOOKING], shift) & wanted for first in range(0, len(words), LOOKING)
        ]
        sets = np.concatenate(found)
        q, place = np.nonzero(sets)
        bits = np.unpackbits(sets[q, place].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return q[which], place[which] * 64 + bit

    def _run(self, codes: np.ndarray, shift: int) -> np.ndarray:
        """The one-error sets of words, after all their letters; codes: (position, word)."""
        shape = (codes.shape[1], len(self.none))
        exact = np.full(shape, ~np.uint64(0))
        one = np.zeros(shape, np.uint64)
        for at, letters in enumerate(codes):
            here = self._at(at, letters)
            if shift == 0:
                one = (one & here) | (exact & ~here)
            elif shift == 1:
                one = (one | exact) & self._at(at + 1, letters)
            else:
                one = (one & self._at(at - 1, letters)) | exact
            exact &= here
        return one | exact if shift == 1 else one


def _codes(values: list[str] | pd.Series) -> np.ndarray:
    return pd.factorize(np.asarray(values, dtype=object))[0]


def _near_in_class(rows: pd.DataFrame, length: int, by_last: bool) -> pd.DataFrame | None:
    """What the words of one length and side find; rows: those of a bucket."""
    rows = rows.sort_values("word", ignore_index=True)  # so that numbers follow the order of the words
    words, ends, counts = rows["word"].tolist(), _codes(rows["ends"]), rows["n"].to_numpy()
    names = np.array(words, dtype=object)
    firsts = _codes([w[: length // 2] for w in words])
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    own = np.flatnonzero(rows["own"])
    if not len(own):
        return None
    index = PositionIndex([words[i] for i in own])
    pairs = []
    for size, shift in ((length, 0), (length, 1), (length + 1, -1)):
        looking = np.flatnonzero(sizes == size)
        if len(looking):
            q, found = index.one_edit([words[i] for i in looking], shift)
            pairs.append((looking[q], own[found]))
    q, found = (np.concatenate(x) for x in zip(*pairs, strict=True))
    keep = ends[q] == ends[found]
    if by_last:  # else found by their first letters already
        keep &= firsts[q] != firsts[found]
    q, found = q[keep], found[keep]
    if not len(q):
        return None
    order = np.lexsort((found, -counts[found], q))
    q, found = q[order], found[order]
    who, first, times = np.unique(q, return_index=True, return_counts=True)
    best = found[first]
    return pd.DataFrame(
        {
            "word": pd.Series(names[who], dtype=object),
            "n_near": times,
            "best_n": counts[best],
            "best": pd.Series(names[best], dtype=object),
        }
    )


def _near_here(rows: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones in a bucket."""
    found = [
        _near_in_class(part, int(length), side == "last") for (length, side), part in rows.groupby(["length", "side"])
    ]
    found = [x for x in found if x is not None]
    return pd.concat(found) if found else pd.DataFrame(columns=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words with near ones; words: written, distinct (word, n)."""
    found = (
        meeting_places(words)
        .groupBy("bucket", "block")
        .applyInPandas(_near_here, "word string, n_near bigint, best_n bigint, best string")
    )
    order = F.struct((-F.col("best_n")).alias("less"), "best")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(order).alias("top"))
        .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to; forms: (word, form), no cycles.

    Each round doubles the way that is known, and is written. A form has at least twice its word's
    count, so rounds grow with the logarithm of the logarithm of the largest count.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = state.join(ahead, "root", "left")
        moved = written(
            step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        state = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return state


def spelling_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    drop_every: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = 2,
) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root.

    A word's form is the most frequent of its near words, ties to the smallest in the order of code points, if it is
    `ratio` times as frequent; ratio: 2 at least, so that forms lead to an end. drop_every: in a document, a word goes
    without its character h % length, from 0, where h, the crc32 of `<id>:<word>`, is a multiple of it; None: no word does.
    """
    if ratio < 2 or least_count < 1:
        raise ValueError("ratio must be 2 or more and least_count 1 or more")
    counted = word_counts(df, id_col, text_col, drop_every)
    words = written(counted.where(f"n >= {least_count} AND char_length(word) >= {least_length}"), "words")
    near = near_words(words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
