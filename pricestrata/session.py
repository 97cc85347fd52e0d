"""Session settings, input tables and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build(
    master: str = "local[8]",
    app: str = "pricestrata",
    partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and bench; a cluster brings its own session and settings."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.pricestrata.spread": str(partitions),
        "spark.ui.showConsoleProgress": "false",
        **(extra or {}),
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out before CPU-heavy row work, where the session asks for it.

    ``spark.pricestrata.spread`` is the number of parts; unset, as on a cluster whose inputs
    are well split, rows stay where the scan put them. Nothing is decided by size.
    """
    parts = df.sparkSession.conf.get("spark.pricestrata.spread", None)
    return df.repartition(int(parts)) if parts else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out over the tasks of the session, for inputs from which much larger rows are made; with ``keys``, by them.

    A table of short rows may be one file with one row group, which is one task however many rows
    it has. Deal the short rows, not what is made of them: only they are shuffled then.
    """
    spark = df.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    return df.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="pricestrata-")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; any other trouble with it is an error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's spark.checkpoint.dir; a local one only where unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: later steps start from the written table."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
