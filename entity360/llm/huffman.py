"""Canonical length-limited Huffman codes over ids, vectorised: lengths, bits, and decoding in lanes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

LIMIT = 18  # bits of the longest code, and of the decoding table's index
CHECKPOINT = 128  # ids between two bit offsets that decoding may start from


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code above `limit` bits, by package-merge.

    Symbols with count 0 get no code (length 0); a single symbol gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, leaves = weights, [np.ones(len(weights), dtype=bool)]
    for _ in range(limit - 1):
        pairs = len(level) // 2
        packages = level[: 2 * pairs : 2] + level[1 : 2 * pairs : 2]
        both = np.concatenate([weights, packages])
        merged = np.argsort(both, kind="stable")
        level = both[merged]
        leaves.append(merged < len(weights))
    take = 2 * len(weights) - 2
    for is_leaf in reversed(leaves):
        n = int(is_leaf[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


@dataclass
class Code:
    """A canonical code: codes of one length are consecutive in the order of the symbols."""

    lengths: np.ndarray

    def __getstate__(self) -> dict:
        return {"lengths": self.lengths}

    @cached_property
    def order(self) -> np.ndarray:
        used = np.flatnonzero(self.lengths)
        return used[np.argsort(self.lengths[used], kind="stable")]

    @cached_property
    def codes(self) -> np.ndarray:
        sizes = self.lengths[self.order].astype(np.uint64)
        wide = np.uint64(1) << (np.uint64(LIMIT) - sizes)  # codes as left-aligned LIMIT bits
        aligned = np.cumsum(wide, dtype=np.uint64) - wide
        out = np.zeros(len(self.lengths), dtype=np.uint64)
        out[self.order] = aligned >> (np.uint64(LIMIT) - sizes)
        return out

    @cached_property
    def table(self) -> np.ndarray:
        """Symbol * 32 + length for each value of the next LIMIT bits."""
        sizes = self.lengths[self.order]
        repeats = 1 << (LIMIT - sizes.astype(np.int64))
        both = np.ones(1 << LIMIT, dtype=np.uint32)
        both[: int(repeats.sum())] = np.repeat(self.order << 5 | sizes, repeats)
        return both

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """Bytes and checkpoints (bit offsets of every CHECKPOINT-th id) of runs of ids.

        sizes: how many ids each run has; every run starts at a byte.
        """
        lengths = self.lengths[ids].astype(np.int64)
        if len(lengths) and not lengths.all():
            raise ValueError("an id has no code")
        ends = np.concatenate(([0], np.cumsum(lengths)))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        run_bits = ends[bounds[1:]] - ends[bounds[:-1]]
        run_bytes = (run_bits + 7) // 8
        starts = np.concatenate(([0], np.cumsum(run_bytes)))
        shift = starts[:-1] * 8 - ends[bounds[:-1]]
        at = ends[:-1] + np.repeat(shift, sizes)
        words = np.zeros(int(starts[-1]) // 8 + 2, dtype=np.uint64)
        if len(ids):
            codes, word = self.codes[ids], at >> 6
            room = 64 - (at & 63) - lengths
            left = codes << np.maximum(room, 0).astype(np.uint64)
            spilt = np.flatnonzero(room < 0)
            left[spilt] = codes[spilt] >> (-room[spilt]).astype(np.uint64)
            firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            words[word[firsts]] = np.add.reduceat(left, firsts)
            words[word[spilt] + 1] |= codes[spilt] << (64 + room[spilt]).astype(np.uint64)
        packed = words.astype(">u8").tobytes()
        payloads = [packed[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        marks = [
            (at[a:b:CHECKPOINT] - s * 8).astype(np.uint32)
            for a, b, s in zip(bounds[:-1], bounds[1:], starts[:-1], strict=True)
        ]
        return payloads, marks

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """All ids of a block; offsets: bit offset of each checkpoint, counts: ids from it on.

        The lanes, one per checkpoint, advance together, one table look-up for each id.
        """
        raw = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, left = offsets[order].astype(np.int64), counts[order]
        place = (np.cumsum(counts) - counts)[order]
        steps = int(left[0]) if len(left) else 0
        lanes = np.searchsorted(-left, -np.arange(steps), side="left").tolist()
        for live in lanes:
            now = at[:live]
            index = ahead[now >> 3] << (now & 7).astype(np.uint32) >> np.uint32(32 - LIMIT)
            found = self.table[index]
            out[place[:live]] = found >> np.uint32(5)
            at[:live] += found & np.uint32(31)
            place[:live] += 1
        return out
