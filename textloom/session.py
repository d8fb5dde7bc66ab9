"""Session settings and lineage cuts.

Intermediate results that a loop reads again are written as Parquet below the shared folder
named by ``spark.checkpoint.dir``, or below the warehouse where that is unset. Losing an executor then costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SCAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # lets the token-shard reader prune files by split and global index
    "spark.sql.python.filterPushdown.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and single-machine runs; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SCAN_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    # the warehouse is always set and shared
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
