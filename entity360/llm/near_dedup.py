"""Near-duplicates: MinHash bands find candidates, odd sketches sift them, full sets confirm.

The set of a text is its distinct 4-word shingles (ASCII letters lower-cased, words split at ASCII
white space). Texts with equal sets are one node. Nodes that share a band hash meet in a bucket.

1. Each node is paired with the least node of each of its buckets.
2. Pairs are sifted by odd sketches: MinHash samples folded into a parity bitmap, so that the
   population count of the exclusive or of two bitmaps estimates their similarity. The same
   bitmap over the whole set gives a bound: its count is never above the symmetric difference.
3. What is left is confirmed on the full sets, and components are formed.
4. Buckets whose nodes are still in different components are searched in full, in pieces of work of
   bounded size. Nodes with a partner in another component that the sieves let pass get their full sets sent to the
   piece, which joins its parts link by link: pairs within a part are left out, the others are confirmed there, and
   only a link that joins two parts leaves it, so a piece puts out fewer links than it has nodes. So no
   connection is lost to the choice of the least node, and pairs never become rows.

With 32 bands of 4 samples a pair of similarity 0.8 shares no bucket with a chance of 5e-8; the sieves
stand five standard deviations below what such a pair gives.

Null and empty texts, and those without words, have no set and are linked with nothing. A text of fewer than
four words has its whole sequence as one shingle. A null id takes part; the id of a component is the
smallest id in it, null only if it has none. Rows that repeat id and text are one document: they stay
or go together. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm import bloom
from entity360.llm.common import column, free_name, written
from entity360.llm.graph import components
from entity360.llm.shingles import MinHash, bands, odd_sketch, parity_of, shingle_sets

WIDTH = 4
SHARE = 80  # per cent of the union
SAMPLES, BAND_ROWS = 128, 4
SKETCH_WORDS, PARITY_WORDS = 4, 16  # of 64 bits
SIGMAS = 5.0
BLOCK = 2_048  # nodes of a bucket that are compared in one task with as many others
BLOCK_SHINGLES = 1 << 21  # the shingles of those nodes, about


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text_key, n, and for texts with words: node, bands, sketch, parity."""
    rows = df.select(
        column(df, id_col).cast("long").alias("id"),
        F.coalesce(column(df, text_col), F.lit("")).alias("text"),
    ).select("id", text_key(F.col("text")).alias("text_key"), "text")
    minhash = MinHash(SAMPLES)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for hashes in shingle_sets(batch["text"].tolist(), WIDTH):
                if not len(hashes):
                    out.append((0, None, None, None, None))
                    continue
                samples = minhash.samples(hashes)
                out.append(
                    (
                        len(hashes),
                        hashlib.md5(hashes.tobytes()).digest(),
                        bands(samples, BAND_ROWS),
                        odd_sketch(samples, SKETCH_WORDS).tobytes(),
                        parity_of(hashes, PARITY_WORDS).tobytes(),
                    )
                )
            made = pd.DataFrame(out, columns=["n", "node", "bands", "sketch", "parity"])
            made.insert(0, "id", batch["id"].to_numpy())
            made.insert(1, "text_key", batch["text_key"].to_numpy())
            yield made

    return rows.mapInPandas(
        signed,
        "id bigint, text_key binary, n bigint, node binary, bands array<bigint>, "
        "sketch binary, parity binary",
    )


def most_differing(bits: int, differing: np.ndarray) -> np.ndarray:
    """The highest count of bits that so many differing items give, but for SIGMAS deviations."""
    gone = np.exp(-2.0 * differing / bits)
    mean = bits / 2 * (1 - gone)
    return mean + SIGMAS * np.sqrt(bits / 4 * (1 - gone * gone))


def _most_in_sketch() -> float:
    """For MinHash samples at the least similarity: twice those that differ fall on the bitmap."""
    share = 1 - SHARE / 100
    differing = SAMPLES * share + SIGMAS * np.sqrt(SAMPLES * share * (1 - share)) * 0.8
    return float(most_differing(SKETCH_WORDS * 64, np.array([2 * differing]))[0])


MOST_IN_SKETCH = _most_in_sketch()


def may_link(
    n_a: np.ndarray,
    n_b: np.ndarray,
    sketch_a: np.ndarray,
    sketch_b: np.ndarray,
    parity_a: np.ndarray,
    parity_b: np.ndarray,
) -> np.ndarray:
    """Where a link is possible; a: one node or as many as b; sketches, parities: 64-bit words."""
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    ok = np.flatnonzero(100 * low >= SHARE * high)

    def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a = a[ok] if len(a) == len(low) else a
        return np.bitwise_count(a ^ b[ok]).sum(axis=1, dtype=np.int64)

    ok = ok[differing(sketch_a, sketch_b) <= MOST_IN_SKETCH]
    most = (low + high)[ok] * (100 - SHARE) // (100 + SHARE)
    bound = np.minimum(most, most_differing(PARITY_WORDS * 64, most))
    return ok[differing(parity_a, parity_b) <= bound]


def _words(column: pd.Series) -> np.ndarray:
    joined = b"".join(column)
    return np.frombuffer(joined, dtype=np.uint64).reshape(len(column), -1)


def sifted(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""
    sides = [
        nodes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "sketch", "parity")])
        for side in "ab"
    ]
    both = pairs.join(sides[0], F.col("a") == F.col("node_a")).join(
        sides[1], F.col("b") == F.col("node_b")
    )

    def sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                n = [batch[f"n_{s}"].to_numpy() for s in "ab"]
                words = [_words(batch[f"{k}_{s}"]) for k in ("sketch", "parity") for s in "ab"]
                yield batch[["a", "b"]].iloc[may_link(*n, *words)]

    return both.drop("node_a", "node_b").mapInPandas(sift, "a binary, b binary")


def texts_of(wanted: DataFrame, nodes: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """(node, text) of some nodes. Only texts that a Bloom filter of the wanted ones lets pass are shuffled."""
    keys = written(nodes.select("node", "text_key").join(wanted.select("node").distinct(), "node"), "wanted")
    texts = df.select(F.coalesce(column(df, text_col), F.lit("")).alias("text")).select(
        text_key(F.col("text")).alias("key"), "text"
    )
    _, some = bloom.split_by(texts, "key", keys.select(F.col("text_key").alias("key")))
    found = some.groupBy("key").agg(F.first("text").alias("text"))
    return found.join(keys, F.col("key") == F.col("text_key")).select("node", "text")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets are linked."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= SHARE * (len(a) + len(b) - shared)


def confirmed(pairs: DataFrame, nodes: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    of_node = written(texts_of(ends, nodes, df, text_col), "texts")
    sides = [of_node.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[bytes, np.ndarray] = {}
            for side in "ab":
                new = batch.drop_duplicates(side)
                new = new[[x not in sets for x in new[side]]]
                made = shingle_sets(new[f"text_{side}"].tolist(), WIDTH)
                sets.update(zip(new[side], made, strict=True))
            keep = [similar(sets[a], sets[b]) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch[["a", "b"]][keep]

    return both.mapInPandas(confirm, "a binary, b binary")


def _whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The sorted rows run by run, whatever batches they come in."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        change = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
        for first, last in zip(change[:-1], change[1:], strict=True):
            yield rows.iloc[first:last]
        rest = rows.iloc[change[-1] :]
    if rest is not None:
        yield rest


_PIECE = ["band", "i", "j"]
_NODE = ["block", "node", "component", "n", "sketch", "parity"]
_WORK = (
    "band bigint, i int, j int, block int, node binary, component binary, n bigint, sketch binary, parity binary"
)


def _candidates(run: pd.DataFrame, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per node of a piece of work the later nodes of other components that the sieves let pass; codes: the
    component of each. In a piece of two blocks only nodes of different blocks are paired."""
    n, block = run["n"].to_numpy(), run["block"].to_numpy()
    sketch, parity = _words(run["sketch"]), _words(run["parity"])
    apart = run["i"].iloc[0] != run["j"].iloc[0]
    for k in range(len(run) - 1):
        rest = codes[k + 1 :] != codes[k]
        if apart:
            rest &= block[k + 1 :] != block[k]
        at = np.flatnonzero(rest) + k + 1
        if len(at):
            me = slice(k, k + 1)
            hits = at[may_link(n[me], n[at], sketch[me], sketch[at], parity[me], parity[at])]
            if len(hits):
                yield k, hits


def _largest_last(run: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The nodes and the codes of their components, those of the largest one last, as it is not searched."""
    codes, _ = pd.factorize(run["component"])
    order = np.argsort(np.bincount(codes)[codes], kind="stable")
    return run.iloc[order], codes[order]


def work_between(crowded: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes of each piece of work that have a partner in another component there, as _WORK.

    crowded: (band, node, n, center, size, shingles). A bucket above BLOCK nodes or BLOCK_SHINGLES shingles is dealt into
    blocks, and each pair of blocks is one piece of work.
    """
    labelled = crowded.where("size > 2").join(
        labels.select("node", "component"), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    open_bands = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("band")
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    dealt = (
        labelled.join(open_bands, "band")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "band",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "node",
            "component",
        )
    )
    work = dealt.join(nodes.select("node", "n", "sketch", "parity"), "node").select(*_PIECE, *_NODE)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _whole_runs(batches, _PIECE):
            run, codes = _largest_last(run)
            needed = np.zeros(len(run), dtype=bool)
            for k, hits in _candidates(run, codes):
                needed[k] = True
                needed[hits] = True
            if needed.any():
                yield run[needed]

    return work.repartition(*_PIECE).sortWithinPartitions(*_PIECE).mapInPandas(compare, _WORK)


def joining_links(run: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links that join the components of a piece of work as far as its links do; run: _WORK and `hashes`, full sets."""
    run, codes = _largest_last(run)
    part = list(range(int(codes.max()) + 1))

    def root(code: int) -> int:
        while part[code] != code:
            part[code] = part[part[code]]
            code = part[code]
        return code

    node = run["node"].tolist()
    sets = [np.frombuffer(raw, dtype=np.uint64) for raw in run["hashes"]]
    out = []
    for k, hits in _candidates(run, codes):
        for h in hits.tolist():
            one, other = root(int(codes[k])), root(int(codes[h]))
            if one != other and similar(sets[k], sets[h]):
                part[one] = other
                out.append((min(node[k], node[h]), max(node[k], node[h])))
    return out


def links_between(
    crowded: DataFrame, labels: DataFrame, nodes: DataFrame, df: DataFrame, text_col: str
) -> DataFrame:
    """Confirmed links that join the components as far as any link of the buckets does."""
    work = written(work_between(crowded, labels, nodes), "work")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [x.tobytes() for x in shingle_sets(batch["text"].tolist(), WIDTH)]
            yield pd.DataFrame({"node": batch["node"], "hashes": pd.Series(sets, dtype=object)})

    def join(run: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(joining_links(run), columns=["a", "b"])

    sets = written(texts_of(work, nodes, df, text_col).mapInPandas(hashed, "node binary, hashes binary"), "sets")
    return work.join(sets, "node").groupBy(*_PIECE).applyInPandas(join, "a binary, b binary").distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_key, n_shingles, component (null without words), component_id and kept."""
    rows = written(signatures(df, id_col, text_col), "signatures")
    nodes = written(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("text_key").alias("text_key"),
            *[F.first(c).alias(c) for c in ("n", "bands", "sketch", "parity")],
        ),
        "nodes",
    )
    members = nodes.select(F.explode("bands").alias("band"), "node", "n")
    centers = (
        members.groupBy("band")
        .agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
        .where("size > 1")
    )
    crowded = written(members.join(centers, "band"), "buckets")
    stars = crowded.where("node != center").select(
        F.col("center").alias("a"), F.col("node").alias("b")
    )
    first = written(confirmed(sifted(stars.distinct(), nodes), nodes, df, text_col), "links")
    labels = written(components(first), "labels")
    more = links_between(crowded, labels, nodes, df, text_col)
    labels = components(first.unionByName(more))
    grouped = rows.select("id", "text_key", F.col("n").alias("n_shingles"), "node").join(
        labels, "node", "left"
    )
    grouped = written(grouped.withColumn("component", F.coalesce("component", "node")), "grouped")
    least = (
        grouped.where("component IS NOT NULL")
        .groupBy("component")
        .agg(F.min("id").alias("least"))
    )
    # A component's rows meet its one row of `least`; a hot one is split by Spark's skew join.
    return grouped.join(least, "component", "left").select(
        "id",
        "text_key",
        "n_shingles",
        "component",
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with the columns of `df`: the one with the smallest id,
    and of rows that share it the one with the least text key.

    Rows that are surely not dropped don't move: a Bloom filter of the dropped ones is asked first.
    """
    groups = written(near_groups(df, id_col, text_col), "groups")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_key"))
    linked = groups.where("component IS NOT NULL")
    best = linked.groupBy("component").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size"))
    gone = written(
        linked.join(best.where("size > 1"), "component")
        .where(~order.eqNullSafe(F.col("best")))
        .select(F.struct("id", "text_key").alias("key"))
        .distinct(),
        "gone",
    )
    key = free_name("__key", df.columns)
    keyed = df.withColumn(
        key,
        F.struct(
            column(df, id_col).cast("long").alias("id"),
            text_key(F.coalesce(column(df, text_col), F.lit(""))).alias("text_key"),
        ),
    )
    stay, maybe = bloom.split_by(keyed, key, gone.select(F.col("key").alias(key)))
    left = maybe.join(gone, maybe[key].eqNullSafe(gone["key"]), "left_anti")
    return stay.unionByName(left).drop(key)
