"""Byte-level BPE of whole texts, with the ids of the tokenizers library, vectorised over a batch.

A text may be cut before a space that a character other than white space follows: the pattern that
splits words never reaches across such a cut, so the pieces are encoded on their own. Of a large batch Arrow
finds the distinct words, which are encoded once; other pieces that a task has seen are, too, within a bound. Pieces of common Latin text go through a
faster library that has the same vocabulary; all others, and texts with the string of a special token, go
through the tokenizers library itself.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Sequence
from functools import cache, cached_property
from itertools import count, islice, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

DEFAULT_FILE, DEFAULT_RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
REMEMBERED, REMEMBERED_CHARS = 150_000, 4 << 20  # pieces and their characters per task; then it starts anew
BATCH_CHARS = 1 << 22  # texts that are encoded together; a longer text is a batch of its own
FEW_CHARS = 1 << 13  # texts that are split without Arrow, which would take longer to set up

_CUT = re.compile(r"(?=\x20(?!\s)(?!$))")
_UNSAFE = re.compile(r"\x20(?:\s|$)")
_LATIN = re.compile(r"[\t-\r\x20-\x7e\xa1-ɏ]*")
_WORD_AFTER_SPACE = r"[\x21-\x7e\xa1-ɏ][\t-\r\x20-\x7e\xa1-ɏ]*"
_WORD = re.compile(r"\x20" + _WORD_AFTER_SPACE)
_ARROW_WORD = rf"^(?:{_WORD_AFTER_SPACE.replace('ɏ', r'\x{24f}')})\z"


class BytePairs:
    """Ids of texts and texts of ids; file, ranks: paths of the same vocabulary in two formats."""

    def __init__(self, file: str | None = None, ranks: str | None = None) -> None:
        self.file = file or public_tokenizers.path(DEFAULT_FILE)
        self.ranks = ranks or public_tokenizers.path(DEFAULT_RANKS)

    def __getstate__(self) -> dict:
        return {"file": self.file, "ranks": self.ranks}

    @property
    def exact(self) -> Tokenizer:
        return _exact(self.file)

    @property
    def fast(self) -> tiktoken.Encoding:
        return _fast(self.ranks)

    @cached_property
    def special(self) -> list[str]:
        return [t.content for t in self.exact.get_added_tokens_decoder().values()]

    @cached_property
    def size(self) -> int:
        """The number of ids."""
        return self.exact.get_vocab_size(with_added_tokens=True)

    @cached_property
    def bytes_of(self) -> np.ndarray:
        """The bytes of each id."""
        out = [b""] * self.size
        for token in range(self.fast.n_vocab):
            out[token] = self.fast.decode_single_token_bytes(token)
        for token, added in self.exact.get_added_tokens_decoder().items():
            out[token] = added.content.encode()
        return np.array(out, dtype=object)

    @cached_property
    def width_of(self) -> np.ndarray:
        """The number of bytes of each id."""
        return np.array([len(x) for x in self.bytes_of], dtype=np.int64)

    def _learn(self, pieces: list[str], memory: _Memory) -> None:
        """Adds the ids of distinct new pieces to the memory."""
        opened = [p for p in pieces if _WORD.fullmatch(p)]
        if opened:
            sizes = np.fromiter(map(len, map(str.encode, opened)), np.int64, len(opened))
            memory.add(opened, *self._opened("".join(opened), sizes))
        others = [p for p in pieces if p not in memory.index]
        found = [
            self.fast.encode_ordinary(p)
            if _LATIN.fullmatch(p)
            else self.exact.encode(p, add_special_tokens=False).ids
            for p in others
        ]
        memory.add(others, [len(ids) for ids in found], [x for ids in found for x in ids])

    def _opened(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece of a text has, and all ids; sizes: bytes of the pieces.

        A space and another character open each piece, so it may be cut there: the pieces are encoded as
        one text, and byte counts tell their ids apart again.
        """
        ids = self.fast.encode_to_numpy(text, disallowed_special=())
        reached = np.searchsorted(np.cumsum(self.width_of[ids]), np.cumsum(sizes)) + 1
        return np.diff(reached, prepend=0), ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out, batch, size = [], [], 0
        for text in texts:
            if batch and size + len(text) > BATCH_CHARS:
                out += self._encoded(batch)
                batch, size = [], 0
            batch.append(text)
            size += len(text)
        return out + self._encoded(batch) if batch else out

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        out = [np.empty(0, np.uint32)] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                ids = self.exact.encode(text, add_special_tokens=False).ids
                out[i] = np.array(ids, dtype=np.uint32)
            else:
                rest.append(i)
        memory = _memory(self.file)
        if len(memory.sizes) > REMEMBERED or memory.chars > REMEMBERED_CHARS:
            memory.clear()
        codes, counts, own_sizes, own_ids = self._pieces([texts[i] for i in rest], memory)
        codes = np.where(codes < 0, len(memory.sizes) + ~codes, codes)
        lengths = np.concatenate((np.array(memory.sizes, dtype=np.int64), own_sizes))
        flat = np.concatenate((np.array(memory.flat, dtype=np.uint32), own_ids))
        known = pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))), flat)
        found = known.take(pa.array(codes))
        ids = found.flatten().to_numpy()
        bounds = np.asarray(found.offsets)[np.cumsum([0, *counts])] - found.offsets[0].as_py()
        for k, i in enumerate(rest):
            out[i] = ids[bounds[k] : bounds[k + 1]]
        return out

    def _pieces(self, texts: list[str], memory: _Memory) -> tuple[np.ndarray, ...]:
        """Numbers of the pieces of texts, and how many each text has.

        Number ~k is piece k of the batch's own, whose sizes and ids follow.
        """
        none = np.empty(0, np.int64), np.empty(0, np.uint32)
        if sum(map(len, texts)) < FEW_CHARS:
            cut = [_cut(text) for text in texts]
            codes = self._codes([p for pieces in cut for p in pieces], memory)
            return codes, np.fromiter(map(len, cut), np.int64, len(cut)), *none
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        firsts, counts = np.asarray(split.offsets)[:-1], np.diff(split.offsets)
        words = split.flatten().dictionary_encode()
        place, distinct = np.asarray(words.indices), words.dictionary
        fit = pc.match_substring_regex(distinct, _ARROW_WORD)
        is_own, own = fit.to_numpy(zero_copy_only=False), distinct.filter(fit)
        others = distinct.filter(pc.invert(fit)).to_pylist()
        numbers = np.empty(len(distinct), np.int64)
        numbers[is_own] = ~np.arange(len(own))
        numbers[~is_own] = self._codes([" " + word for word in others], memory)
        codes = numbers[place]
        codes[firsts] = self._codes(distinct.take(pa.array(place[firsts])).to_pylist(), memory)
        # No cut is before a space that white space or the end follows: such words go on with the piece before.
        uncut = np.zeros(len(distinct), bool)
        uncut[~is_own] = [not word or word[0].isspace() for word in others]
        goes_on = uncut[place]
        goes_on[firsts] = False
        if goes_on.any():
            starts = np.flatnonzero(~goes_on)
            sizes = np.diff(starts, append=len(place))
            longer = np.flatnonzero(sizes > 1)
            whole = np.repeat(sizes > 1, sizes)
            held = iter(distinct.take(pa.array(place[whole])).to_pylist())
            opens = np.isin(starts[longer], firsts).tolist()
            merged = [
                ("" if first else " ") + " ".join(islice(held, n))
                for first, n in zip(opens, sizes[longer].tolist(), strict=True)
            ]
            codes = codes[starts]
            codes[longer] = self._codes(merged, memory)
            counts = np.diff(np.searchsorted(starts, np.append(firsts, len(place))))
        if not len(own):
            return codes, counts, *none
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(own)], own.cast(pa.string())), " ")
        sizes = np.asarray(pc.binary_length(own)).astype(np.int64) + 1
        return codes, counts, *self._opened(" " + joined[0].as_py(), sizes)

    def _codes(self, pieces: list[str], memory: _Memory) -> np.ndarray:
        """The numbers of pieces in the memory, new ones learned."""
        codes = np.fromiter(map(memory.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(codes < 0).tolist()
        self._learn(list(dict.fromkeys(pieces[i] for i in new)), memory)
        codes[new] = [memory.index[pieces[i]] for i in new]
        return codes

    def forget(self) -> None:
        """Frees what the process has remembered; to be called at the end of a task, whose worker goes on living."""
        _memory(self.file).clear()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; broken characters are replaced."""
        return b"".join(self.bytes_of[ids]).decode("utf-8", "replace")


def _cut(text: str) -> list[str]:
    if _UNSAFE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first] + [" " + word for word in rest]


@cache
def _exact(file: str) -> Tokenizer:
    found = Tokenizer.from_file(file)
    found.no_truncation()
    found.no_padding()
    return found


class _Memory:
    """Known pieces of a process: their numbers, and the sizes and ids in that order."""

    def __init__(self) -> None:
        self.clear()

    def add(self, pieces: list[str], sizes: Sequence[int], ids: Sequence[int]) -> None:
        self.index.update(zip(pieces, count(len(self.sizes))))
        self.chars += sum(map(len, pieces))
        self.sizes.frombytes(np.asarray(sizes, dtype=np.int32).tobytes())
        self.flat.frombytes(np.asarray(ids, dtype=np.uint32).tobytes())

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.sizes = array("i")
        self.flat = array("I")
        self.chars = 0


@cache
def _memory(file: str) -> _Memory:
    return _Memory()


@cache
def _fast(ranks: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        pairs = dict(line.split() for line in lines if line.strip())
    return tiktoken.Encoding(
        "byte pairs",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs.items()},
        special_tokens={},
    )
