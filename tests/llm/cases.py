"""Rows that every operator has to take: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.001"
LONG = "word number one two three four five six seven eight nine ten " * 5_000
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, id string, ID2 int, key binary, "
    "node int, digest string, whole int, row int, range int, size int, __maybe boolean, tie map<string, int>"
)


def messy_rows() -> list[tuple[int | None, str | None]]:
    return [
        (1, None),
        (2, ""),
        (None, "a text without an id"),
        (None, "a text without an id"),
        (3, "the same row twice"),
        (3, "the same row twice"),
        (3, "the same id with another text"),
        (4, "The  Same\trow twice"),
        (5, " \n\t "),
        (6, LONG),
        (7, LONG + "end"),
        (8, "one two three"),
        (9, "one\ntwo\x0bthree"),
        (10, "日本語のテキスト 😀 \x1c x   y"),
        (11, "<|endoftext|> inside <|endoftext|>"),
    ]


def table_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents of (doc_id, text), with columns whose names the operators use inside."""
    full = [(i, t, "en", "s", "x", 1, b"k", 2, "d", 3, 4, 5, 6, True, {"a": 1}) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def messy(spark: SparkSession) -> DataFrame:
    return table_of(spark, messy_rows())


def empty(spark: SparkSession) -> DataFrame:
    return table_of(spark, [])


def documents(spark: SparkSession, folder: str = FOLDER) -> list[tuple[int, str]]:
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)
