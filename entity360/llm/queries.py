"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity360.llm import bpe_reuse, decontaminate, html_extract, language_id, secrets, token_files, toxicity
from entity360.llm.common import crc_bucket, new_path
from entity360.llm.exact_dedup import exact_groups
from entity360.llm.hard_negatives import mine
from entity360.llm.near_dedup import near_groups
from entity360.llm.sharding import shard_by_bytes
from entity360.llm.spelling import spelling_groups
from entity360.llm.tokenizer import BytePairs
from entity360.llm.topk_search import nearest

SHARDS = 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", toxicity.score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, folder, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return shard_by_bytes(table(spark, folder, "documents"), SHARDS).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _joined(spans: str) -> Column:
    return F.expr(
        f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    )


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base finds, and all spans."""
    counts = [
        F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) AS long)").alias(f"n_{kind}")
        for kind in secrets.KINDS
    ]
    return secrets.scan(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        "layers",
    )


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_groups(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = language_id.train(docs)
    found = docs.select("doc_id", language_id.identify(model, F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.accepted").alias("accepted"),
    )


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document, and of what they decode to."""
    pairs = BytePairs()
    docs = table(spark, folder, "documents")
    return bpe_reuse.encode(docs, pairs, made=bpe_reuse.digests(pairs)).withColumnRenamed("id", "doc_id")


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents: one row per document and item."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.leaks(docs, items).withColumnRenamed("id", "doc_id")


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document, written to files and read back."""
    path = new_path(spark, "token-files")
    token_files.write_files(table(spark, folder, "documents"), path)
    return token_files.read_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32")
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_groups(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, the words one edit from them, and the form and root of each."""
    found = spelling_groups(table(spark, folder, "documents"), drop_every=97)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best vectors for every fiftieth one."""
    return nearest(table(spark, folder, "embeddings"), queries="id % 50 = 0", k=5)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector and its five best positives."""
    vectors = table(spark, folder, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(vectors.withColumn("label", moved), anchors="id % 50 = 0", positives=5, negatives=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extraction": op2_html_extraction,
    "op3_sharding": op3_sharding,
    "op4_secret_scans": op4_secret_scans,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_bpe": op7_bpe,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_files": op9_token_files,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_topk_search": op12_topk_search,
    "op13_hard_negatives": op13_hard_negatives,
}

# The usable rows of `embeddings` with integer components, each under a number of its own.
_VECTORS = """
    usable AS (
        SELECT row_number() OVER () AS row_no, *,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    )
"""


def _score(a: str, b: str) -> str:
    """The inner product of two lists; the longer one's rest counts nothing."""
    places = f"range(1, least(len({a}), len({b})) + 1)"
    return f"CAST(coalesce(list_sum(list_transform({places}, lambda i: {a}[i] * {b}[i])), 0) AS BIGINT)"


ORACLE_SQL: dict[str, str] = {
    "op10_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
            min(doc_id) OVER copies AS keep_id,
            count(*) OVER copies AS group_size,
            doc_id = min(doc_id) OVER copies AS kept,
            text_sha256
        FROM digests
        WINDOW copies AS (PARTITION BY text_sha256)
    """,
    "op12_topk_search": f"""
        WITH {_VECTORS},
        scored AS (
            SELECT q.row_no, q.vec_id AS query_id, r.vec_id, {_score("q.parts", "r.parts")} AS score
            FROM usable q JOIN usable r ON q.row_no <> r.row_no
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY row_no ORDER BY score DESC, vec_id NULLS LAST
            ) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op13_hard_negatives": f"""
        WITH {_VECTORS},
        labelled AS (
            SELECT row_no, vec_id, parts,
                CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label
            FROM usable WHERE label IS NOT NULL
        ),
        scored AS (
            SELECT a.row_no AS anchor, a.vec_id AS anchor_id, r.row_no, r.vec_id, a.label = r.label AS same,
                {_score("a.parts", "r.parts")} AS score
            FROM labelled a JOIN labelled r ON a.row_no <> r.row_no
            WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT anchor, anchor_id, row_no, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
            CAST(row_number() OVER (
                PARTITION BY p.anchor, p.row_no ORDER BY s.score DESC, s.vec_id NULLS LAST
            ) AS INTEGER) AS rank,
            s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
            AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
}
