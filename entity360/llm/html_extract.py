"""Main text of web pages: what a host repeats on its pages is boilerplate, the rest is kept.

The words of all blocks of each page form a token stream. The streams of a host are put together and
their suffixes sorted; suffixes that share their first RUN tokens stand side by side in the suffix
array, so it shows on how many distinct pages each run of RUN tokens occurs. A run is boilerplate if
these are at least LEAST_PAGES, and LEAST_SHARE of all distinct pages of the host. Pages with the same
content (below) are one page here, at whatever addresses and in whatever frames they stand.

A large host is dealt into batches by its pages' content, each with a suffix array of its own. A run on
LEAST_SHARE of a host's pages is on LEAST_SHARE of some batch's, so only such runs leave a batch, and
these are then counted on all pages of the host. Tokens are CODE_BYTES long: they are stored once and
shuffled once. Two words with one code, a chance of 2**-24, would have to stand between the same seven
others on as many pages as boilerplate to be taken for the same.

The content of a page is its article element; without one, its blocks outside menus,
footers, sidebars, adverts, forms and comments. The text is the content without words that boilerplate
runs cover, within an article too. A page of which nothing would be left keeps its content whole, as it
is a copy. What is no copy word for word but nearly so counts as a page of its own, so what nearly equal pages
have in common goes where they are LEAST_SHARE of a host.

Null and empty pages and pages without text give the empty text. Rows that repeat address and html
are one page for the counts and one row each in the result. A null address is a host of its own. Hosts
are told apart by a 64-bit hash. Pages of any length are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm import bloom
from entity360.llm.common import column, written
from entity360.llm.html_blocks import ARTICLE, OTHER, Block, blocks
from entity360.llm.shingles import mixed, rolled, word_hashes

RUN = 8  # tokens of the shortest run that counts as repeated
LEAST_PAGES = 3  # two pages may share a quote or be a page and its revision
LEAST_SHARE = 0.5  # of a host's distinct pages; so its boilerplate is at most twice a mean page long
BATCH_TOKENS = 50_000  # of a host's streams in one suffix array
CODE_BYTES = 3  # of a token
LIST_BYTES = 1 << 25  # of all hosts' runs together, if they are to be sent to all executors
PARTS = 16  # that each host is dealt into where they are more


def content_place(found: list[Block]) -> str:
    """The place whose blocks are the content of a page."""
    return ARTICLE if any(b.place == ARTICLE for b in found) else OTHER


def content_text(found: list[Block]) -> str:
    """The content of a page, whole."""
    place = content_place(found)
    return "\n\n".join(b.text for b in found if b.place == place)


def all_tokens(found: list[Block]) -> np.ndarray:
    """Codes of the words of all blocks."""
    words = word_hashes([b.text.encode("utf-8", "surrogatepass") for b in found])[0]
    return words >> np.uint64(64 - 8 * CODE_BYTES)


def packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // CODE_BYTES, 8), dtype=np.uint8)
    out[:, :CODE_BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, CODE_BYTES)
    return out.reshape(-1).view("<u8")


def window_hashes(tokens: np.ndarray, length: int = RUN) -> np.ndarray:
    """Hashes of all runs of `length` tokens."""
    return rolled(mixed(tokens), length) if len(tokens) >= length else np.empty(0, np.uint64)


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all suffixes by their first `length` tokens (a power of two), by prefix doubling."""
    ranks = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < length:
        after = np.zeros_like(ranks)
        after[: len(ranks) - step] = ranks[step:]
        ranks = np.unique(ranks * (ranks.max(initial=0) + 1) + after, return_inverse=True)[1] + 1
        step *= 2
    return ranks


def repeated_runs(streams: list[np.ndarray], length: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `length` tokens, and on how many of the streams each occurs.

    The suffix array is the order of the ranks; equal ranks are one interval of it.
    """
    sizes = np.array([len(s) for s in streams])
    tokens = np.concatenate(streams) if streams else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(streams)), sizes)
    if len(tokens) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = window_hashes(tokens, length)
    whole = owner[: len(hashes)] == owner[length - 1 :]  # runs that stay on one page
    ranks = suffix_ranks(tokens, length)[: len(hashes)]
    array = np.lexsort((owner[: len(hashes)], ranks))
    array = array[whole[array]]
    new_rank = np.concatenate(([True], ranks[array][1:] != ranks[array][:-1]))
    new_page = new_rank | np.concatenate(([True], owner[array][1:] != owner[array][:-1]))
    if not len(array):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    starts = np.flatnonzero(new_rank)
    return hashes[array[starts]], np.add.reduceat(new_page.astype(np.int64), starts)


def covered(tokens: np.ndarray, runs: np.ndarray, length: int = RUN) -> np.ndarray:
    """Which tokens lie within one of the runs (hashes, sorted)."""
    marks = np.zeros(len(tokens) + 1, dtype=np.int64)
    if len(tokens) >= length and len(runs):
        hashes = window_hashes(tokens, length)
        at = np.minimum(np.searchsorted(runs, hashes), len(runs) - 1)
        hits = np.flatnonzero(runs[at] == hashes)
        np.add.at(marks, hits, 1)
        np.add.at(marks, hits + length, -1)
    return np.cumsum(marks[:-1]) > 0


def _long_stretches(mask: np.ndarray) -> np.ndarray:
    """The mask without stretches below RUN: there a run only reaches in from the next block."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    out = np.zeros(len(mask), dtype=bool)
    for first, last in zip(edges[0::2], edges[1::2], strict=True):
        out[first:last] = last - first >= RUN
    return out


def unique_text(found: list[Block], mask: np.ndarray) -> str:
    """The content without its covered words, or whole if nothing is left; mask: of all_tokens."""
    kept, at, place = [], 0, content_place(found)
    for block in found:
        words = block.text.split(" ")
        own = mask[at : at + len(words)]
        at += len(words)
        if block.place == place:
            gone = own if own.all() else _long_stretches(own)
            text = " ".join(w for w, c in zip(words, gone, strict=True) if not c)
            if text:
                kept.append(text)
    return "\n\n".join(kept) or content_text(found)


def host(url: str | Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def beside(rows: DataFrame, lists: DataFrame, by: Sequence[str], list_bytes: int) -> DataFrame:
    """The rows with the `runs` of their host (null: none); lists: written.

    Lists of at most `list_bytes` go to all executors. Others meet the rows by host and one of PARTS
    parts, so that a hot host is no single key; rows of hosts without a list aren't shuffled then.
    """
    size = lists.agg(F.sum(F.size("runs") + 3)).first()[0] or 0
    if size * 8 <= list_bytes:
        return rows.join(F.broadcast(lists), "host", "left")
    straight, maybe = bloom.split_by(rows, "host", lists.select("host"))
    parts = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.pmod(F.xxhash64(*by), F.lit(PARTS)).cast("int")
    met = maybe.withColumn("part", part).join(parts, ["host", "part"], "left").drop("part")
    return met.unionByName(straight, allowMissingColumns=True)


def _listed(runs: DataFrame) -> DataFrame:
    return runs.groupBy("host").agg(F.sort_array(F.collect_set("run")).alias("runs"))


def _known(runs: Sequence[int] | None) -> np.ndarray:
    return np.sort(np.asarray(() if runs is None else runs, np.int64).view(np.uint64))


def streams_of(placed: DataFrame) -> DataFrame:
    """Per page with words: host, key of its content, number of tokens, and these, packed."""

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, counts, tokens = [], [], []
            for page in batch["html"]:
                found = blocks(page)
                text = content_text(found).encode("utf-8", "surrogatepass")
                keys.append(hashlib.sha256(b" ".join(text.split())).digest()[:16])
                codes = all_tokens(found)
                counts.append(len(codes))
                tokens.append(packed(codes))
            yield pd.DataFrame({"host": batch["host"], "key": keys, "n": counts, "tokens": tokens})

    schema = "host bigint, key binary, n bigint, tokens binary"
    return placed.select("host", "html").mapInPandas(streamed, schema).where("n > 0")


def boilerplate(placed: DataFrame, list_bytes: int = LIST_BYTES) -> DataFrame:
    """Per host that has any: the hashes of its boilerplate runs, sorted."""
    streams = written(streams_of(placed), "streams")
    # What is decided on keys and sizes alone doesn't read the tokens.
    contents = written(
        streams.groupBy("host", "key").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "contents"
    )
    sizes = contents.groupBy("host").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("n") / BATCH_TOKENS)).cast("int").alias("batches"),
        F.greatest(F.lit(LEAST_PAGES), F.ceil(F.count(F.lit(1)) * LEAST_SHARE)).alias("least"),
        F.count(F.lit(1)).alias("all"),
    )
    sizes = written(sizes.where(F.col("all") >= LEAST_PAGES).drop("all"), "hosts")
    # Of pages of the same content, the least stream is counted; the others needn't be compared.
    copied = written(contents.where("copies > 1").select(F.xxhash64("host", "key").alias("id")), "copied")
    single, maybe = bloom.split_by(streams.withColumn("id", F.xxhash64("host", "key")), "id", copied)
    columns = ["host", "key", "tokens"]
    once = single.select(*columns).unionByName(maybe.groupBy("host", "key").agg(F.min("tokens").alias("tokens")))
    dealt = once.join(sizes, "host").withColumn("batch", F.pmod(F.xxhash64("key"), F.col("batches")).cast("int"))

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        runs, pages_of = repeated_runs([unpacked(t) for t in group["tokens"]])
        alone = bool(group["batches"].iloc[0] == 1)
        least = group["least"].iloc[0] if alone else np.ceil(LEAST_SHARE * len(group))
        runs = runs[pages_of >= least]
        return pd.DataFrame({"host": group["host"].iloc[0], "run": runs.view(np.int64), "alone": alone})

    schema = "host bigint, run bigint, alone boolean"
    found = written(dealt.groupBy("host", "batch").applyInPandas(counted, schema), "batch-runs")
    likely = written(_listed(found.where("NOT alone")), "likely-runs")

    def pages_with(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, rows in batch.groupby("host"):
                known = _known(rows["runs"].iloc[0])
                hits = [np.intersect1d(window_hashes(unpacked(t)), known) for t in rows["tokens"]]
                runs, pages_of = np.unique(np.concatenate(hits), return_counts=True)
                yield pd.DataFrame({"host": name, "run": runs.view(np.int64), "pages": pages_of})

    again = beside(dealt.where("batches > 1").select("host", "key", "tokens"), likely, ["key"], list_bytes)
    counts = (
        again.where("runs IS NOT NULL")
        .select("host", "tokens", "runs")
        .mapInPandas(pages_with, "host bigint, run bigint, pages bigint")
        .groupBy("host", "run")
        .agg(F.sum("pages").alias("pages"))
        .join(sizes.select("host", "least"), "host")
        .where(F.col("pages") >= F.col("least"))
    )
    # LEAST_SHARE bounds the list of a host.
    runs = found.where("alone").select("host", "run").unionByName(counts.select("host", "run"))
    return written(_listed(runs), "boilerplate")


def extract(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    list_bytes: int = LIST_BYTES,
) -> DataFrame:
    """Per row: id, url, text."""
    placed = df.select(
        column(df, id_col).cast("long").alias("id"),
        column(df, url_col).alias("url"),
        F.coalesce(column(df, html_col), F.lit("")).alias("html"),
        F.xxhash64(host(column(df, url_col))).alias("host"),
    )

    def freed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page, runs in zip(batch["html"], batch["runs"], strict=True):
                found = blocks(page)
                if runs is None:
                    texts.append(content_text(found))
                else:
                    texts.append(unique_text(found, covered(all_tokens(found), _known(runs))))
            yield batch[["id", "url"]].assign(text=texts)

    met = beside(placed, boilerplate(placed, list_bytes), ["id", "html"], list_bytes)
    return met.select("id", "url", "html", "runs").mapInPandas(freed, "id bigint, url string, text string")
