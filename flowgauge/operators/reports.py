"""Aggregates, reports and dashboard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .quality import recent


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "occurrences") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def average_by(df: DataFrame, dimensions: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*dimensions).agg(*[F.avg(m).alias(f"avg_{m}") for m in measures])


def average_last_minute(df: DataFrame, as_of: Column, measure: str = "sensor_0", seconds: int = 60,
                        log_axis: bool = False, epoch: str | None = "sensor_ts") -> DataFrame:
    """Average per sensor over the newest readings."""
    fresh = recent(df, as_of, seconds, epoch=epoch)
    result = fresh.groupBy("sensor_id").agg(F.avg(measure).alias(f"avg_{measure}"))
    if log_axis:
        result = result.withColumn(f"log_{measure}", F.when(F.col(f"avg_{measure}") > 0, F.log10(f"avg_{measure}")))
    return result


def newest(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """Top ``n`` rows, newest first; Spark keeps ``n`` rows per task and merges them."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def time_span(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              classes: Sequence = (0, 1)) -> DataFrame:
    """Counts per label (rows) and prediction (columns)."""
    counts = [F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes]
    return df.groupBy(F.col(label).cast("int").alias(label)).agg(*counts)


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Words (runs of word characters, lower case) and how often each occurs."""
    words = df.select(F.explode(F.split(F.lower(column), r"\W+")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
