"""Sliding and tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.epoch import epoch_us, floor_div, interval_seconds
from ..streaming import sliding

STATS = ["sensorCount", "sensorSum", "sensorAverage", "sensorMin", "sensorMax", "sensorGreaterThan60"]


def _window_stats(value: str, threshold: float) -> list[Column]:
    v = F.col(value)
    return [
        F.count(F.lit(1)).alias("sensorCount"),
        F.sum(v).alias("sensorSum"),
        F.avg(v.cast("float")).alias("sensorAverage"),
        F.min(v).alias("sensorMin"),
        F.max(v).alias("sensorMax"),
        F.sum(F.when(v > threshold, 1).otherwise(0)).cast("bigint").alias("sensorGreaterThan60"),
    ]


def sliding_stats(
    df: DataFrame,
    keys: Sequence[str] = ("sensor_id",),
    value: str = "sensor_6",
    time: str = "event_time",
    size: str = "30 seconds",
    slide: str = "1 second",
    threshold: float = 70,
    end: str = "windowEnd",
) -> DataFrame:
    """Statistics of a reading over windows of ``size`` that start every ``slide``.

    Rows are first folded to one cell per key and slide, and only the cells are
    spread over the windows they belong to; all six statistics recombine
    exactly.  The spread rows number at most ``size / slide`` times the cells,
    not times the readings.  On a stream the state holds the cells of open
    windows (:mod:`..streaming.sliding`); without keys, or with keys or values
    of other types, both steps are windowed aggregates.
    """
    step, length = interval_seconds(slide), interval_seconds(size)
    if length % step:
        grouped = df.groupBy(*keys, F.window(time, size, slide).alias("_w"))
        return grouped.agg(*_window_stats(value, threshold)).select(*keys, F.col("_w.end").alias(end), *STATS)

    v = F.col(value)
    cell_stats = [
        F.count(F.lit(1)).alias("_count"),
        F.sum(v).alias("_sum"),
        F.sum(v.cast("float").cast("double")).alias("_fsum"),
        F.count(v).alias("_present"),
        F.min(v).alias("_min"),
        F.max(v).alias("_max"),
        F.count_if(v > threshold).alias("_over"),
    ]
    window_stats = [
        F.sum("_count").alias("sensorCount"),
        F.sum("_sum").alias("sensorSum"),
        (F.sum("_fsum") / F.nullif(F.sum("_present"), F.lit(0))).alias("sensorAverage"),
        F.min("_min").alias("sensorMin"),
        F.max("_max").alias("sensorMax"),
        F.sum("_over").alias("sensorGreaterThan60"),
    ]
    types = dict(zip(df.columns, [f.dataType for f in df.schema]))
    if df.isStreaming and sliding.fits([types[k] for k in keys], types[value]):
        runs = sliding.window_runs(df, keys, value, time, slide, step, length // step, threshold)
        windows = runs.withColumn("_end", F.explode(F.sequence("_first", "_last")))
        return windows.select(
            *keys, F.timestamp_micros(F.col("_end") * (step * 1_000_000)).alias(end), F.col("_count").alias("sensorCount"),
            F.col("_sum").alias("sensorSum"), (F.col("_fsum") / F.nullif("_present", F.lit(0))).alias("sensorAverage"),
            F.col("_min").alias("sensorMin"), F.col("_max").alias("sensorMax"), F.col("_over").alias("sensorGreaterThan60"))
    if df.isStreaming:
        cells = df.groupBy(*keys, F.window(time, slide).alias("_cell")).agg(*cell_stats)
        totals = cells.groupBy(*keys, F.window("_cell", size, slide).alias("_w")).agg(*window_stats)
        return totals.select(*keys, F.col("_w.end").alias(end), *STATS)

    step_us = step * 1_000_000
    cells = (
        df.filter(F.col(time).isNotNull())
        .groupBy(*keys, floor_div(epoch_us(time), step_us).alias("_cell")).agg(*cell_stats)
    )
    # Ends of the windows that hold a cell: its own end and the following ones.
    ends = F.sequence(F.col("_cell") + 1, F.col("_cell") + F.lit(length // step))
    totals = cells.withColumn("_end", F.explode(ends)).groupBy(*keys, "_end").agg(*window_stats)
    return totals.select(*keys, F.timestamp_micros(F.col("_end") * step_us).alias(end), *STATS)


def tumbling_sum(df: DataFrame, keys: Sequence[str] = ("sensor_id",), value: str = "sensor_0",
                 time: str | None = "event_time", size: str = "10 seconds") -> DataFrame:
    """Sum per key and window; ``time=None`` takes the processing time."""
    if time is None:
        df, time = with_event_time(df, F.current_timestamp(), "0 seconds", "_now"), "_now"
    return (
        df.groupBy(*keys, F.window(time, size).alias("_w")).agg(F.sum(value).alias("total"))
        .select(*keys, F.col("_w.end").alias("windowEnd"), "total")
    )


def with_event_time(df: DataFrame, time: Column, watermark: str | None = "3 seconds",
                    name: str = "event_time") -> DataFrame:
    """Event-time column, with a lateness bound on streams."""
    df = df.withColumn(name, time.cast("timestamp"))
    return df.withWatermark(name, watermark) if watermark and df.isStreaming else df
