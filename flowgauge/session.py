"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def get_spark(app: str = "flowgauge", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators count on.

    Partition numbers are left to the cluster; AQE merges small partitions and
    splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets one below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and still there if executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 2_000_000) -> tuple[DataFrame, int]:
    """A written table with a broadcast hint if it has few rows, and its number of rows."""
    rows = df.count()
    return (F.broadcast(df) if rows <= max_rows else df), rows


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/flowgauge/{name}-{uuid.uuid4().hex}"
