"""Topic records: totals, lag, selection, replication, continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import decode_bytes, digit_runs


def selected_topics(allow: str, deny: str | None = None, column: str = "topic") -> Column:
    """Topic matches the allow pattern and not the deny pattern, each from end to end."""
    chosen = F.col(column).rlike(f"^(?:{allow})$")
    return chosen & ~F.col(column).rlike(f"^(?:{deny})$") if deny else chosen


def partition_totals(records: DataFrame) -> DataFrame:
    """Messages and bytes per topic and partition."""
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))


def topic_totals(records: DataFrame) -> DataFrame:
    """Messages and bytes per partition, per topic and overall, with the number of partitions.

    The rollup runs over the per-partition totals, so rows are not multiplied.
    """
    return (
        partition_totals(records).rollup("topic", "partition")
        .agg(F.sum("messages").alias("messages"), F.sum("bytes").alias("bytes"),
             F.count(F.lit(1)).alias("partitions"))
    )


def producer_totals(records: DataFrame, client: Column) -> DataFrame:
    """Messages per producer and topic."""
    return records.groupBy(client.alias("client_id"), "topic").agg(F.count(F.lit(1)).alias("messages"))


def consumer_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages each group has still to read, per topic; a partition never committed counts from 0."""
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    groups = committed.select("group_id", "topic").distinct()
    wanted = groups.join(ends, "topic")
    lag = wanted.join(committed, ["group_id", "topic", "partition"], "left")
    behind = F.greatest(F.col("end_offset") - F.coalesce("committed", F.lit(0)), F.lit(0))
    return lag.groupBy("group_id", "topic").agg(
        F.sum(F.coalesce("committed", F.lit(0))).alias("committed"), F.sum(behind).alias("lag"))


def flow_check(records: DataFrame, max_lag: int = 1, lag: DataFrame | None = None) -> DataFrame:
    """Per topic: is data coming in, and (with ``lag``) are readers keeping up."""
    totals = partition_totals(records).groupBy("topic").agg(F.sum("bytes").alias("bytes_in"))
    checked = totals.withColumn("flowing", F.col("bytes_in") > 0)
    if lag is None:
        return checked
    queued = lag.groupBy("topic").agg(F.max("lag").alias("queued"))
    return checked.join(queued, "topic", "left").withColumn(
        "keeping_up", F.coalesce("queued", F.lit(0)) <= max_lag)


def replicate(records: DataFrame, source: str, allow: str, deny: str | None = None,
              target: str | None = None) -> DataFrame:
    """Chosen topics under their replica name ``<source>.<topic>``.

    Topics that already came from the target are left out, so copying in both
    directions does not loop.
    """
    chosen = records.filter(selected_topics(allow, deny))
    if target:
        chosen = chosen.filter(~F.col("topic").startswith(f"{target}."))
    return chosen.withColumn("topic", F.concat(F.lit(f"{source}."), F.col("topic")))


def with_replicas(records: DataFrame, topic: str) -> DataFrame:
    """A topic together with its replicas of any source."""
    return records.filter((F.col("topic") == topic) | F.col("topic").endswith(f".{topic}"))


def continuity_gap(before: DataFrame, after: DataFrame, value: str = "value") -> DataFrame:
    """Whole seconds between the last digit-run timestamp before and the first after; negative is an overlap."""
    times = _timestamps(before, value).withColumn("_after", F.lit(False)).unionByName(
        _timestamps(after, value).withColumn("_after", F.lit(True)))
    ends = times.agg(F.max(F.when(~F.col("_after"), F.col("t"))).alias("last_before"),
                     F.min(F.when(F.col("_after"), F.col("t"))).alias("first_after"))
    gap = F.call_function("div", F.col("first_after") - F.col("last_before"), F.lit(1_000_000).cast("bigint"))
    return ends.withColumn("gap_seconds", gap)


def _timestamps(df: DataFrame, value: str) -> DataFrame:
    text = decode_bytes(value) if dict(df.dtypes)[value] == "binary" else F.col(value)
    return digit_runs(df.select(text.alias("v")), "v").select(F.col("run").try_cast("bigint").alias("t"))
