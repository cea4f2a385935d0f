"""Word shingles as 64-bit hashes, MinHash samples and odd sketches, vectorised over a batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SEED = 20_240_615
PIECE_BYTES = 1 << 18  # of text that is hashed at once; a longer text is hashed in steps
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)  # odd, so powers of it have inverses modulo 2**64

_random = np.random.default_rng(SEED)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_ORDINAL = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: All ASCII bytes but letters and digits.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_P ** i and its inverse for i from 0 to n."""
    inverse = _U(pow(int(_P), -1, 1 << 64))
    out = []
    for base in (_P, inverse):
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


_POWER, _INVERSE = _powers(PIECE_BYTES)


def _words(raw: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of a text; a word that a step cuts goes on in the next one."""
    hashes, firsts = [], []
    open_sum, open_length, open_start = 0, 0, 0
    for at in range(0, len(raw), PIECE_BYTES):
        part = raw[at : at + PIECE_BYTES]
        inside = np.concatenate(([False], ~separators[part], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        added = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[_LOWER[part]] * _POWER[: len(part)], out=added[1:])
        sums = (added[ends] - added[starts]) * _INVERSE[starts]
        lengths, starts = (ends - starts).astype(np.uint64), starts + at
        if open_length:
            if len(starts) and starts[0] == at:
                shift = pow(int(_P), open_length, 1 << 64)
                sums[0] = _U((open_sum + shift * int(sums[0])) % (1 << 64))
                lengths[0] += _U(open_length)
                starts[0] = open_start
            else:
                sums = np.concatenate(([_U(open_sum)], sums))
                lengths = np.concatenate(([_U(open_length)], lengths))
                starts = np.concatenate(([open_start], starts))
            open_length = 0
        if len(ends) and ends[-1] == len(part) and at + len(part) < len(raw):
            open_sum, open_length, open_start = int(sums[-1]), int(lengths[-1]), int(starts[-1])
            sums, lengths, starts = sums[:-1], lengths[:-1], starts[:-1]
        hashes.append(mixed(sums + lengths))
        firsts.append(starts)
    return np.concatenate(hashes), np.concatenate(firsts)


def word_hashes(
    texts: Sequence[bytes], separators: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased, and the index of each word's text.

    separators: for each byte whether it parts words.
    """
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes, starts = _words(raw, separators)
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(firsts, starts, side="right") - 1


def pieces(texts: Sequence[str]) -> Iterator[list[bytes]]:
    """The texts in UTF-8, in lists of bounded size."""
    piece, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if piece and size + len(raw) > PIECE_BYTES:
            yield piece
            piece, size = [], 0
        piece.append(raw)
        size += len(raw) + 1
    if piece:
        yield piece


def shingle_sets(texts: Sequence[str], width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `width` words.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    for piece in pieces(texts):
        yield from _sets(piece, width)


def sequence_hash(words: np.ndarray) -> np.ndarray:
    """One hash for all words, as an array of one."""
    places = mixed(np.arange(1, len(words) + 1, dtype=np.uint64))
    return mixed(np.array([np.sum(words * (places | _U(1)))], dtype=np.uint64) + _U(len(words)))


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` words."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out += words[i : i + n] * _ORDINAL[i]
    return mixed(out)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    words, owner = word_hashes(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    shingles = rolled(words, width)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= width:
            yield np.unique(shingles[first : last - width + 1])
        elif last > first:
            yield sequence_hash(words[first:last])
        else:
            yield np.empty(0, dtype=np.uint64)


class MinHash:
    """`n` MinHash samples of a set of hashes."""

    def __init__(self, n: int) -> None:
        random = np.random.default_rng(SEED + 1)
        self.factors = random.integers(1, 1 << 63, n, dtype=np.uint64) | _U(1)
        self.terms = random.integers(0, 1 << 63, n, dtype=np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), ~_U(0))
        for at in range(0, len(hashes), 512):  # stays in the cache
            part = hashes[at : at + 512, None] * self.factors + self.terms
            np.minimum(least, part.min(axis=0), out=least)
        return mixed(least)


def bands(samples: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each run of `rows` samples; equal runs at other places differ."""
    parts = samples.reshape(-1, rows)
    sums = np.sum(parts * _ORDINAL[:rows], axis=1, dtype=np.uint64)
    return mixed(sums + np.arange(len(parts), dtype=np.uint64)).view(np.int64)


def odd_sketch(samples: np.ndarray, words: int) -> np.ndarray:
    """The samples folded into a bitmap of `words` * 64 bits: a bit is set if an odd number of
    samples fell on it, so the exclusive or of two sketches is the sketch of their difference."""
    places = mixed(samples + np.arange(len(samples), dtype=np.uint64) * _P) % _U(words * 64)
    counts = np.bincount(places.astype(np.int64), minlength=words * 64)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def parity_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """The odd sketch of a whole set."""
    counts = np.bincount((hashes % _U(words * 64)).astype(np.int64), minlength=words * 64)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)
