"""Secrets in whole texts, also behind nested encodings.

Three kinds are searched in each layer: assignments, access keys and long hexadecimal runs. The
layers of a text form a worklist: percent escapes and Unicode escapes are undone over the whole
layer, each base64 run opens layers of its own, and compressed streams are inflated in windows, one
after the other where several are joined. Bytes that are not UTF-8 become U+FFFD and the rest is searched;
bytes with LEAST_NULS zeros or more, the fewest that any find in wide characters has, are read as
UTF-16 too. New layers are searched and unwrapped in turn until
nothing new appears; a layer with known content at a known place is not entered twice, so streams
that contain themselves end. Every find is mapped to code points of the original text: to the
characters it came from, or to the whole run for compressed data.

Null and empty texts have no finds. There is no limit on depth or length: inflated data is handled
in windows of WINDOW characters that overlap by OVERLAP, so a find up to that length is never cut. A
base64 run that is open at a window's end goes on in step in the next one, or is held until it ends if
it is a compressed stream. A stream that is cut short or broken is searched as far as it goes.
Rows may repeat; each is searched on its own. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from entity360.llm.common import id_and_text

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
OPEN = re.compile(r"[A-Za-z0-9+/_=-]*")
WINDOW, OVERLAP = 1 << 22, 1 << 16
LEAST_NULS = 15  # of 16 wide hexadecimal digits, the first or last of which may lack its zero

Span = tuple[int, int, str]


class Layer(NamedTuple):
    """Text, and where each of its characters starts and ends in the original (None: the same)."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the finds in plain text, by start, then kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= LEAST_ASSIGN
        ]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if len(m[0]) >= LEAST_ACCESS
        ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def _decoded(data: bytes) -> tuple[str, np.ndarray]:
    """Bytes as UTF-8, bad ones as U+FFFD, and how many bytes each character took."""
    text = data.decode("utf-8", "surrogateescape")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    bad = (codes >= 0xDC80) & (codes <= 0xDCFF)  # a byte each; real surrogates are no UTF-8
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
    if bad.any():
        text = np.where(bad, np.uint32(0xFFFD), codes).astype("<u4").tobytes().decode("utf-32-le")
    return text, np.where(bad, 1, sizes)


def _wide(data: bytes) -> Iterator[tuple[int, str, np.ndarray]]:
    """Bytes that may be UTF-16, read as such: offset, text, and bytes of each character.

    High bytes first at an offset are the same as low bytes first at the next one, for characters below
    U+0100; so without a mark of the order both offsets of one order do, and no find comes twice.
    """
    if data.count(0) < LEAST_NULS:
        return
    marked = data[:2] == b"\xfe\xff"
    for offset in (0,) if marked else (0, 1):
        whole = data[offset:] + b"\0"
        text = whole[: len(whole) // 2 * 2].decode("utf-16-be" if marked else "utf-16-le", "surrogatepass")
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        sizes = 2 + 2 * (codes >= 0x10000).astype(np.int64)
        if sizes.sum() > len(data) - offset:
            sizes[-1] -= 1
        yield offset, text, sizes


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match decoded. decode: a match to its text and how many characters of the
    match each new one took, or None where these don't add up, and all share the match's bounds."""
    pieces, at, starts, ends = [], 0, [], []

    def same(begin: int, end: int) -> None:
        pieces.append(layer.text[begin:end])
        place = np.arange(begin, end)
        starts.append(place if layer.starts is None else layer.starts[begin:end])
        ends.append(place + 1 if layer.ends is None else layer.ends[begin:end])

    for m in pattern.finditer(layer.text):
        new, sizes = decode(m[0])
        same(at, m.start())
        pieces.append(new)
        if sizes is None:
            bounds = [layer.place(*m.span())] * len(new)
        else:
            last = (m.start() + np.cumsum(sizes)).tolist()
            bounds = [layer.place(e - n, e) for e, n in zip(last, sizes.tolist(), strict=True)]
        starts.append(np.array([b[0] for b in bounds], dtype=np.int64))
        ends.append(np.array([b[1] for b in bounds], dtype=np.int64))
        at = m.end()
    if not at:
        return None
    same(at, len(layer.text))
    return Layer("".join(pieces), np.concatenate(starts), np.concatenate(ends))


def _percent(run: str) -> tuple[str, np.ndarray]:
    text, sizes = _decoded(bytes.fromhex(run.replace("%", "")))
    return text, 3 * sizes


def _escaped(run: str) -> tuple[str, np.ndarray | None]:
    units = re.findall(r"\\u(....)|\\x(..)", run)
    text = "".join(chr(int(a or b, 16)) for a, b in units)
    sizes = np.array([6 if a else 4 for a, _ in units])
    # Two halves of one character may be escaped one by one.
    whole = text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")
    return whole, sizes if len(whole) == len(text) else None


def _inflater(data: bytes):
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _before_error(inflater, data: bytes) -> Iterator[bytes]:
    """What comes out of a stream up to the byte that breaks it."""
    for k in range(len(data)):
        try:
            if piece := inflater.decompress(data[k : k + 1]):
                yield piece
        except zlib.error:
            return


def _chunks(data: bytes, trailer: bool) -> Iterator[bytes]:
    """The inflated streams, one after the other, in pieces of bounded size; trailer: also what follows them."""
    rest = data
    while inflater := _inflater(rest):
        while not inflater.eof:
            before = inflater.copy() if hasattr(inflater, "copy") else None
            try:
                piece = inflater.decompress(rest, WINDOW)
            except zlib.error:
                yield from _before_error(before, rest)
                raise
            rest = inflater.unconsumed_tail if hasattr(inflater, "unconsumed_tail") else b""
            yield piece
            if not piece and not rest and not inflater.eof:
                return  # cut short
        rest = inflater.unused_data
    if rest and trailer:
        yield rest


def _bytes_of(run: str) -> bytes:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    run = run[: len(run) - (len(run) % 4 == 1)]  # one character more than whole bytes
    return base64.b64decode(run + "=" * (-len(run) % 4))


def _next_start(text: str) -> int:
    """Where in this window the next one starts."""
    at = max(0, len(text) - OVERLAP)
    opened = len(text) - OPEN.match(text[::-1]).end()
    if opened >= at:
        return at
    if "=" not in text[opened : opened + 16] and _inflater(_bytes_of(text[opened : opened + 16])):
        return opened
    return at - (at - opened) % 4


def _inflated(
    data: bytes, bounds: tuple[int, int], outer: frozenset[bytes] = frozenset()
) -> Iterator[Layer]:
    """Text windows of a compressed stream, streams within streams included; outer: digests of
    the streams around it, which end a stream that contains itself."""
    digest = hashlib.sha256(data).digest()
    if digest in outer:
        return

    def layer(text: str) -> Layer:
        return Layer(text, np.full(len(text), bounds[0]), np.full(len(text), bounds[1]))

    decoder, tail, wide = codecs.getincrementaldecoder("utf-8")("replace"), "", b""
    try:
        chunks = _chunks(data, bool(outer))  # in base64 the trailer is read at its place
        head = next(chunks, b"")
        if _inflater(head):  # a stream in the stream: it is as long as what it was packed into
            yield from _inflated(head + b"".join(chunks), bounds, outer | {digest})
            # What only looks like a stream is text as well.
            chunks = _chunks(data, bool(outer))
            head = next(chunks, b"")
        while head:
            wide += head
            for _, text, _ in _wide(wide):
                yield layer(text)
            wide = wide[-2 * OVERLAP :]
            tail += decoder.decode(head)
            start = _next_start(tail)
            if start or len(tail) <= OVERLAP:
                yield layer(tail)
            tail, head = tail[start:], next(chunks, b"")
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        pass  # not a stream after all, or cut short: what was read of it is searched
    if tail:
        yield layer(tail)


def _from_base64(layer: Layer) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        data = _bytes_of(m[0])
        if _inflater(data):
            yield from _inflated(data, layer.place(*m.span()))
        for offset, text, sizes in ((0, *_decoded(data)), *_wide(data)):
            # Byte i comes from the characters i * 4 // 3 to (i * 8 + 7) // 6; a character from its bytes.
            last = offset + np.cumsum(sizes) - 1
            first = last - sizes + 1
            low, high = m.start() + first * 8 // 6, m.start() + (last * 8 + 7) // 6
            if layer.starts is not None:
                low, high = layer.starts[low], layer.ends[high] - 1
            yield Layer(text, low, high + 1)


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside a layer."""
    text = layer.text
    if "%" in text and (inner := _replaced(layer, PERCENT, _percent)):
        yield inner
    if "\\" in text and (inner := _replaced(layer, ESCAPED, _escaped)):
        yield inner
    yield from _from_base64(layer)


def all_spans(text: str) -> tuple[list[Span], list[Span], int]:
    """The base spans, all spans, and the number of layers that were searched."""
    base = base_spans(text)
    found, seen, layers = set(base), set(), 1
    work = [unwrapped(Layer(text))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        place = layer.place(0, len(layer.text)) if layer.text else (0, 0)
        key = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), place)
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        for start, end, kind in base_spans(layer.text):
            found.add((*layer.place(start, end), kind))
        work.append(unwrapped(layer))
    return base, sorted(found, key=_order), layers


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base and spans as arrays of (kind, start, end), and layers searched."""

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [all_spans(t) for t in batch["text"]]
            listed = [
                [[{"kind": k, "start": s, "end": e} for s, e, k in r[i]] for r in rows] for i in (0, 1)
            ]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "base": pd.Series(listed[0], dtype=object),
                    "spans": pd.Series(listed[1], dtype=object),
                    "layers": pd.Series([r[2] for r in rows], dtype="int64"),
                }
            )

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    return id_and_text(df, id_col, text_col).mapInPandas(
        scanned, f"id bigint, base {span}, spans {span}, layers bigint"
    )
