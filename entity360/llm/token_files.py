"""Token ids in files: Huffman-coded blocks in ascending order of document ids.

Format: the folder `blocks` holds Parquet rows of (part, block, first, ids, counts, sizes, checkpoints, payload).
A part is one sorted range of documents. A block has whole documents with BLOCK_IDS ids or one more
document; `first` counts the ids of the part before it; `ids`, `counts` and `sizes` list the documents, their numbers
of ids and of bytes; `checkpoints` are bit offsets from a document's first bit, one for every
CHECKPOINT ids, little-endian 32-bit; `payload` is the documents' bits, each from a full byte on.
The folder `code` holds (id, length) of the canonical code. A block is decoded by itself, and within a
block from any checkpoint.

Documents are sorted by id, nulls first, rows that share an id by the hash of their text. Null texts
have the end id only. Empty tables give files without blocks. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entity360.llm.common import id_and_text, new_path, slices
from entity360.llm.huffman import CHECKPOINT, Code, code_lengths
from entity360.llm.tokenizer import BATCH_CHARS, BytePairs

BLOCK_IDS = 1 << 16
CODED_BYTES = 1 << 19  # that are counted, coded or decoded at once
END_ID = 0

BLOCK_ROW = (
    "part int, block int, first bigint, ids array<bigint>, counts array<bigint>, "
    "sizes array<bigint>, checkpoints binary, payload binary"
)


def token_ids(
    df: DataFrame, pairs: BytePairs, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, tie (hash of the text) and tokens, with the end id, in the narrowest type.

    The low bytes of all ids come before their high bytes, so that files compress well.
    """
    kind = _kind(pairs)

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_CHARS):
                ids = pairs.encode(part["text"].tolist())
                found = [_planes(np.append(x, np.uint32(END_ID)).astype(kind)) for x in ids]
                yield part[["id", "tie"]].assign(tokens=pd.Series(found, dtype=object).to_numpy())

    rows = id_and_text(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    return rows.mapInPandas(tokens, "id bigint, tie bigint, tokens binary")


def _kind(pairs: BytePairs) -> np.dtype:
    return np.dtype("<u2" if pairs.size <= 1 << 16 else "<u4")


def _planes(ids: np.ndarray) -> bytes:
    return ids.view(np.uint8).reshape(-1, ids.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: np.dtype) -> np.ndarray:
    bytes_ = np.frombuffer(raw, dtype=np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(bytes_.T).reshape(-1).view(kind)


def global_code(tokens: DataFrame, pairs: BytePairs) -> Code:
    """The code for the counts of all ids; each task adds up its own first."""
    kind, size = _kind(pairs), pairs.size

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "tokens", CODED_BYTES):
                ids = np.concatenate([_from_planes(raw, kind) for raw in part["tokens"]])
                total += np.bincount(ids, minlength=size)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    counts = np.zeros(size, dtype=np.int64)
    sums = tokens.select("tokens").mapInPandas(counted, "id bigint, n bigint")
    for row in sums.groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row per known id
        counts[row.id] = row.n
    return Code(code_lengths(counts))


def write_files(
    df: DataFrame,
    path: str,
    pairs: BytePairs | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """The ids of all rows in the format above."""
    spark = df.sparkSession
    pairs = pairs or BytePairs()
    kind = _kind(pairs)
    stored = new_path(spark, "tokens")
    token_ids(df, pairs, id_col, text_col).write.option("compression", "zstd").parquet(stored)
    tokens = spark.read.schema("id bigint, tie bigint, tokens binary").parquet(stored)
    code = global_code(tokens, pairs)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "tokens", CODED_BYTES):
                ids = [_from_planes(raw, kind) for raw in part["tokens"]]
                sizes = np.array([len(x) for x in ids])
                payloads, marks = code.encode(np.concatenate(ids), sizes)
                yield part[["part", "id"]].assign(
                    n=sizes,
                    payload=pd.Series(payloads, dtype=object).to_numpy(),
                    checkpoints=pd.Series([m.tobytes() for m in marks], dtype=object).to_numpy(),
                )

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, first, held, total = 0, 0, [], 0

        def made() -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "part": [held[0].part],
                    "block": [block],
                    "first": [first],
                    "ids": [[None if pd.isna(r.id) else int(r.id) for r in held]],
                    "counts": [[r.n for r in held]],
                    "sizes": [[len(r.payload) for r in held]],
                    "checkpoints": [b"".join(r.checkpoints for r in held)],
                    "payload": [b"".join(r.payload for r in held)],
                }
            )

        for batch in coded(batches):
            for row in batch.itertuples(index=False):
                held.append(row)
                total += row.n
                if total >= BLOCK_IDS:
                    yield made()
                    block, first, held, total = block + 1, first + total, [], 0
        if held:
            yield made()

    # Sorted first and coded then: drawing the range bounds reads the stored ids, and codes nothing.
    sorted_rows = (
        tokens.repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
        .select(F.spark_partition_id().alias("part"), "id", "tokens")
    )
    sorted_rows.mapInPandas(blocked, BLOCK_ROW).write.option("compression", "none").parquet(
        f"{path}/blocks"
    )
    lengths = [(int(i), int(code.lengths[i])) for i in np.flatnonzero(code.lengths)]
    spark.createDataFrame(lengths, "id bigint, length int").coalesce(1).write.parquet(f"{path}/code")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, and tokens as
    little-endian 32-bit integers."""
    blocks = spark.read.schema(BLOCK_ROW).parquet(f"{path}/blocks")
    known = spark.read.schema("id bigint, length int").parquet(f"{path}/code").collect()
    lengths = np.zeros(max((r.id for r in known), default=0) + 1, dtype=np.uint8)
    for row in known:
        lengths[row.id] = row.length
    code = Code(lengths)
    # One row per part, as many as there are files: one task adds them up, all may hold them.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        blocks.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch, "payload", CODED_BYTES):
                # Several blocks at once: their lanes advance together.
                counts = [np.asarray(n, dtype=np.int64) for n in part["counts"]]
                sizes = np.concatenate([np.asarray(n, dtype=np.int64) for n in part["sizes"]])
                n = np.concatenate(counts)
                marks = -(-n // CHECKPOINT)
                checkpoints = np.frombuffer(b"".join(part["checkpoints"]), dtype="<u4")
                offsets = checkpoints + np.repeat((np.cumsum(sizes) - sizes) * 8, marks)
                each = np.full(int(marks.sum()), CHECKPOINT)
                each[np.cumsum(marks) - 1] = n - (marks - 1) * CHECKPOINT
                tokens = code.decode(b"".join(part["payload"]), offsets, each).astype("<u4", copy=False)
                ends = np.cumsum(n)
                firsts = zip(part["offset"] + part["first"], counts, strict=True)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(
                            [None if pd.isna(i) else i for ids in part["ids"] for i in ids], dtype="Int64"
                        ),
                        "start": np.concatenate([first + np.cumsum(m) - m for first, m in firsts]),
                        "n_tokens": n,
                        "tokens": [tokens[a:b].tobytes() for a, b in zip(ends - n, ends, strict=True)],
                    }
                )

    return (
        blocks.join(F.broadcast(parts), F.col("part") == F.col("of"))
        .select("offset", "first", "ids", "counts", "sizes", "checkpoints", "payload")
        .mapInPandas(decoded, "doc_id bigint, start bigint, n_tokens bigint, tokens binary")
    )
