"""The corpus pipeline: each stage works on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
`docs`; the last one returns what BPE makes of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entity360.llm.bpe_reuse import digests, encode
from entity360.llm.common import new_path
from entity360.llm.decontaminate import drop_leaks
from entity360.llm.exact_dedup import drop_copies
from entity360.llm.near_dedup import drop_near_copies
from entity360.llm.tokenizer import BytePairs
from entity360.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below 0.5."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its ids, and digest of what they decode to."""
    pairs = BytePairs()
    return encode(docs, pairs, made=digests(pairs)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe),
]

ORACLE_SQL = None  # a learned model and near-duplicates can't be stated in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
