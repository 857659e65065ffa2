"""Filters, checks and routing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def implausible(columns: Sequence[str] = ("sensor_0", "sensor_1"), limit: float = 500) -> Column:
    """True where any of the readings is at or above the limit; null readings do not count."""
    test = F.lit(False)
    for c in columns:
        test = test | (F.col(c) >= F.lit(limit))
    return F.coalesce(test, F.lit(False))


def drop_implausible(df: DataFrame, columns: Sequence[str] = ("sensor_0", "sensor_1"), limit: float = 500) -> DataFrame:
    return df.filter(~implausible(columns, limit))


def above_score(df: DataFrame, column: str = "fraud_score", threshold: float = 0.90) -> DataFrame:
    return df.filter(F.col(column) > F.lit(threshold))


def bound_query(spark: SparkSession, sql: str, parameters: Mapping) -> DataFrame:
    """SQL text with named parameters (``:name``); values never become part of the text."""
    return spark.sql(sql, args=dict(parameters))


def recent(df: DataFrame, as_of: Column, seconds: int = 60, time: str = "event_time",
           epoch: str | None = None) -> DataFrame:
    """Rows newer than ``as_of`` less some seconds.

    With ``epoch`` (a stored microsecond column) the same bound is put on it as
    well, so files are skipped by their statistics.
    """
    bound = as_of - F.make_dt_interval(secs=F.lit(seconds))
    kept = df.filter(F.col(time) > bound)
    if epoch:
        kept = kept.filter(F.col(epoch) > F.unix_micros(bound.cast("timestamp")))
    return kept


def expire(df: DataFrame, ingest: str, event: str = "event_time", seconds: int = 60) -> DataFrame:
    """Records that were no older than ``seconds`` when they came in."""
    age = F.unix_micros(F.col(ingest).cast("timestamp")) - F.unix_micros(F.col(event).cast("timestamp"))
    return df.filter(age <= F.lit(seconds * 1_000_000))


def unpivot_readings(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per reading: ids, ``sensor``, ``reading``."""
    return df.unpivot(list(ids), list(columns), "sensor", "reading")


def range_profile(df: DataFrame, columns: Sequence[str], low: float = 0, high: float = 100,
                  suspicious: float = 150) -> DataFrame:
    """Per sensor: smallest and largest reading, and how many fall outside the limits.

    All columns are aggregated in one pass and only the one-row result is turned
    into a row per sensor, so the input is not multiplied.
    """
    parts = []
    for c in columns:
        r = F.col(c)
        parts += [F.min(r).alias(f"{c}_min"), F.max(r).alias(f"{c}_max"),
                  F.count_if((r < low) | (r > high)).alias(f"{c}_out"),
                  F.count_if(r > suspicious).alias(f"{c}_susp")]
    totals = df.agg(*parts)
    rows = F.array(*[
        F.struct(F.lit(c).alias("sensor"), F.col(f"{c}_min").alias("min_reading"),
                 F.col(f"{c}_max").alias("max_reading"), F.col(f"{c}_out").alias("out_of_range"),
                 F.col(f"{c}_susp").alias("suspicious"))
        for c in columns
    ])
    return totals.select(F.inline(rows))


def route(df: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Named outputs, each with its own projection and predicate; a row may go to several."""
    return {name: fn(df) for name, fn in outputs.items()}


def split(df: DataFrame, **predicates: Column) -> dict[str, DataFrame]:
    """Rows by the predicates they meet; rows that meet none go to ``unmatched``."""
    outputs, any_match = {}, F.lit(False)
    for name, predicate in predicates.items():
        holds = F.coalesce(predicate, F.lit(False))
        outputs[name] = df.filter(holds)
        any_match = any_match | holds
    outputs["unmatched"] = df.filter(~any_match)
    return outputs
