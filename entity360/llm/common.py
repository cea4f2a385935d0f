"""Helpers that the operators share: the folder all executors see, and column handling."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='llm-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends there, and every
    executor finds them again if another is lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """`name`, with underscores before it until no column of that name exists in any case."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return df["`" + name.replace("`", "``") + "`"]


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only `id` and `text` (null: empty), so that no other column can clash."""
    return df.select(
        column(df, id_col).cast("long").alias("id"),
        F.coalesce(column(df, text_col), F.lit("")).alias("text"),
    )


def crc_bucket(value: Column, n: int) -> Column:
    """crc32 of a value as text, modulo n: the fold of a labelled row."""
    return F.pmod(F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def slices(batch: pd.DataFrame, name: str, most: int) -> Iterator[pd.DataFrame]:
    """The rows in runs whose values in a column are `most` long together; a longer one is alone."""
    start, size = 0, 0
    for k, n in enumerate(map(len, batch[name])):
        if k > start and size + n > most:
            yield batch.iloc[start:k]
            start, size = k, 0
        size += n
    if start < len(batch):
        yield batch.iloc[start:]
