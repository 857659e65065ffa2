"""Late rows of a stream, set aside before an operator drops them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.epoch import floor_div, interval_seconds

MARKS = "newest_ms bigint"


def newest_upto(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Newest event time, in milliseconds, of the micro-batches up to one: a row that each micro-batch leaves."""
    if batch_id < 0:
        return None
    try:
        return spark.read.schema(MARKS).parquet(f"{path}/marks/of={batch_id}").select("newest_ms").first()[0]
    except AnalysisException as error:  # the job began later
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def window_end_ms(time: str, size: str) -> Column:
    """End of the tumbling window of a row, in milliseconds."""
    width = interval_seconds(size) * 1_000_000
    return floor_div((floor_div(F.unix_micros(time), width) + 1) * width, 1000)


def late_sink(path: str, on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None],
              size: str, time: str = "event_time", delay_ms: int = 3000) -> Callable[[DataFrame, int], None]:
    """Sink that parts the rows of a stream into those an aggregate over windows of ``size`` takes, and late ones.

    Spark judges the rows of a micro-batch by the watermark of the batch before
    it, which knows the batches before that one: a row is late if its window
    ends at that watermark or earlier.  The watermark is the newest event time,
    to the millisecond, less the delay.  Rows without a time are on time, as
    they pass an aggregate's watermark filter.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            newest = newest_upto(spark, path, batch_id - 2)
            before = newest_upto(spark, path, batch_id - 1)
            rows.agg(F.greatest(F.max(F.unix_millis(time)), F.lit(before).cast("bigint")).alias("newest_ms")).write.mode(
                "overwrite").parquet(f"{path}/marks/of={batch_id}")
            behind = F.lit(False) if newest is None else F.coalesce(
                window_end_ms(time, size) <= newest - delay_ms, F.lit(False))
            on_time(rows.filter(~behind), batch_id)
            late(rows.filter(behind), batch_id)
        finally:
            rows.unpersist()
    return write
