"""Runtime settings the models rely on."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one extra exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot compiles no method above 8,000 bytes; without this, such a stage is interpreted row by row.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Groups that arrive in order are added up one after another; gathering ones, too: they are too many for a map.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    # What a task scans it may have to sort, as for the newest events; by 32 MB that fits into its memory.
    "spark.sql.files.maxPartitionBytes": "32MB",
    # A query's shuffle files go when it is done; otherwise they stay until the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Choose joins by the rows and values that published tables are known to hold.
COST_SETTINGS = {"spark.sql.cbo.enabled": "true"}


def tune(spark: SparkSession, costs: bool = False) -> SparkSession:
    """Apply the runtime SQL settings; they can be set on a running session.

    ``costs`` also lets Spark estimate sizes from the statistics of tables, where these are kept.
    """
    for key, value in (RUNTIME_SETTINGS | (COST_SETTINGS if costs else {})).items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='entity360-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the scratch folder and read back, so that several readers share them."""
    path = f"{scratch_folder(df.sparkSession)}/models/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # hex keys take half the space
    return df.sparkSession.read.schema(df.schema).parquet(path)
