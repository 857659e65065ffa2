"""Reading the tables, scratch tables in the shared folder, and streams of Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets a folder below its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    return folder.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and still there if executors are lost."""
    path = f"{scratch_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame) -> int:
    """As many partitions as Spark shuffles to by default."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def plain_text(name: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts hold about ``most_bytes``, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin, held = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def by_slices(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], column: str, most_bytes: int):
    """A function for ``mapInArrow``: ``make`` runs once in each task and gives what is applied to each slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for part in slices(batches, column, most_bytes):
            yield apply(part)
    return run
