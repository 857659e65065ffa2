"""Count windows, running sums and the inactivity monitor on streams.

They need the order of rows inside a key, or what came before.  They run the
batch operators on each micro-batch and keep a small row per key (rows seen and
at most ``size - 1`` left-over rows; the total so far; the last time) in a keyed
table, so a hot key is still spread over tasks.  A micro-batch reads the state
of the hash buckets its keys fall into, and writes those.  The state read for a
batch is that of the batches before it, so a repeated batch gives the same
result.  Run :func:`keyed.compact` on ``path/state`` beside the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.epoch import floor_div
from ..operators.ordered import (
    HOT_ROWS, closed_windows, gaps_and_ends, latest_per_key, position, running_sum, window_parts)
from ..sources.schemas import HASH_PARTITIONS
from .keyed import bucket_of, read_keyed, write_changes


def _looked_at(rows: DataFrame, keys: Sequence[str], buckets: int, hot_rows: int) -> tuple[int | None, list[int]]:
    """From one pass over a batch: ``hot_rows``, or none where all its rows together are too few for a hot key, and
    the hash buckets of its keys."""
    found = rows.agg(F.count(F.lit(1)), F.collect_set(bucket_of(keys, buckets))).first()
    return (hot_rows if found[0] > hot_rows else None), sorted(found[1])


def count_window_sink(path: str, keys: Sequence[str], order: Sequence[str], value: str, size: int = 3,
                      carry: Sequence[str] = (), hot_rows: int = HOT_ROWS,
                      buckets: int = HASH_PARTITIONS) -> Callable[[DataFrame, int], None]:
    """Every ``size`` rows of a key give one row below ``path/windows``: sum, and row with the largest value."""
    state_path = f"{path}/state"
    fields = list(dict.fromkeys([value, *carry]))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*dict.fromkeys([*keys, *order, *fields])).persist()
        held = [rows]
        try:
            hot, only = _looked_at(rows, keys, buckets, hot_rows)
            state = read_keyed(batch.sparkSession, state_path, keys, before=batch_id, only=only)
            numbered = position(rows, keys, order, "_position", hot).select(*keys, *fields, "_position")
            if state is not None:
                known = state.join(rows.select(*keys).distinct(), list(keys), "left_semi").persist()
                held.append(known)
                shifted = numbered.join(known.select(*keys, "seen"), list(keys), "left")
                new = shifted.select(*keys, *fields, (F.col("_position") + F.coalesce("seen", F.lit(0))).alias("_position"))
                waiting = known.select(*keys, "seen", F.posexplode("waiting").alias("_i", "_row")).select(
                    *keys, *[F.col(f"_row.{c}").alias(c) for c in fields],
                    (F.col("seen") - F.pmod(F.col("seen"), F.lit(size)) + F.col("_i") + 1).alias("_position"))
                numbered = new.unionByName(waiting)
            parts = window_parts(numbered, keys, value, size, carry).persist()
            held.append(parts)
            closed_windows(parts, keys, value, size, carry).write.mode("overwrite").parquet(f"{path}/windows/batch_id={batch_id}")
            # The last window of a key, if incomplete, holds the rows that wait.
            end = (F.col("window_no") * size + F.col("_n")).alias("seen")
            rest = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in fields])).alias("waiting")
            last = parts.select(*keys, end, F.when(F.col("_n") < size, rest).alias("waiting"))
            write_changes(latest_per_key(last, keys, ["seen"], keep=["seen", "waiting"]), state_path, batch_id, keys,
                          buckets=buckets, unique=True)
        finally:
            for frame in held:
                frame.unpersist()

    return write


def running_sum_sink(path: str, keys: Sequence[str], order: Sequence[str], value: str, out: str = "running_sum",
                     keep: Callable[[DataFrame], DataFrame] = lambda d: d, hot_rows: int = HOT_ROWS,
                     buckets: int = HASH_PARTITIONS) -> Callable[[DataFrame, int], None]:
    """Each row with the sum of its key so far, below ``path/rows``; ``keep`` filters what is written."""
    state_path = f"{path}/state"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            totals = rows.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_sum"))
            hot, only = _looked_at(rows, keys, buckets, hot_rows)
            summed = running_sum(rows, keys, order, value, out, hot)
            state = read_keyed(batch.sparkSession, state_path, keys, before=batch_id, only=only)
            if state is not None:
                known = state.join(totals.select(*keys), list(keys), "left_semi")
                before = F.coalesce("total", F.lit(0))
                summed = summed.join(known, list(keys), "left").withColumn(out, F.col(out) + before).drop("total")
                totals = totals.join(known, list(keys), "left").withColumn("_sum", F.col("_sum") + before)
            keep(summed).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
            write_changes(totals.select(*keys, F.col("_sum").alias("total")), state_path, batch_id, keys,
                          buckets=buckets, unique=True)
        finally:
            rows.unpersist()

    return write


MONITOR_OUTPUT = "monitor string, state string, at_us bigint, silent_us bigint, alert bigint, repeats bigint"


def with_heartbeat(df: DataFrame, time: str = "event_time", beat: str = "beat") -> DataFrame:
    """A stream with a row each second that only carries the time, so that silence of the whole stream is noticed."""
    ticks = df.sparkSession.readStream.format("rate").load().select(F.col("timestamp").alias(time), F.lit(True).alias(beat))
    return df.withColumn(beat, F.lit(False)).unionByName(ticks, allowMissingColumns=True)


def monitor_sink(path: str, threshold: int = 45, time: str = "event_time", key: str | None = None, delay: int = 3,
                 beat: str | None = None, buckets: int = HASH_PARTITIONS) -> Callable[[DataFrame, int], None]:
    """Messages of an inactivity monitor below ``path/messages``, one monitor per key or one over all.

    ``inactive`` when nothing came for ``threshold`` seconds, again for each further ``threshold``
    seconds, and ``restored`` when records come again.  Repeated messages are one row: the first
    (``alert``, ``at_us``, ``silent_us``) and how many (``repeats``); :func:`each_alert` spreads them.

    The rows of a micro-batch are folded to the ends of time cells before the shuffle, and their order
    is taken over chunks of cells, so no task sees all rows of a monitor.  The clock is the newest event
    time so far less ``delay`` seconds; at each micro-batch the monitors whose next message is due by
    then fire, whether they are in the batch or not.  Rows with a true ``beat`` only move the clock.
    The state is one row per monitor.  Records that are older than the last one of their monitor in an
    earlier micro-batch change nothing.
    """
    step, late = threshold * 1_000_000, delay * 1_000_000
    state_path = f"{path}/state"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        monitor = F.col(key).cast("string") if key else F.lit("all")
        rows = batch.filter(F.col(time).isNotNull()).select(
            monitor.alias("monitor"), F.col(time).cast("timestamp").alias("event_time"),
            (F.coalesce(F.col(beat), F.lit(False)) if beat else F.lit(False)).alias("beat")).persist()
        held = [rows]
        try:
            state = read_keyed(spark, state_path, ["monitor"], before=batch_id)
            if state is None:
                state = spark.createDataFrame([], "monitor string, last_us bigint, alerts bigint")
            state = state.withColumnRenamed("monitor", "_m").persist()
            clock = rows.select(F.unix_micros("event_time").alias("us")).unionByName(
                state.select(F.col("last_us").alias("us"))).agg(F.max("us")).first()[0]
            held.append(state)
            if clock is None:
                return
            # The last record known of each monitor counts with those of the batch.
            known = state.select(F.col("_m").alias("monitor"), F.timestamp_micros("last_us").alias("event_time"))
            gaps, ends = gaps_and_ends(rows.filter("NOT beat").drop("beat").unionByName(known), ["monitor"], "event_time", threshold)
            with_state = lambda df: df.join(state, F.col("monitor").eqNullSafe(F.col("_m")), "left").drop("_m")
            closed = with_state(gaps.select("monitor", F.unix_micros("inactive_from").alias("from_us"),
                                            F.unix_micros("restored_at").alias("to_us"), F.col("alerts").alias("due"))).filter(
                F.col("last_us").isNull() | (F.col("to_us") > F.col("last_us"))).withColumn(
                "told", F.when(F.col("from_us") == F.col("last_us"), F.col("alerts")).otherwise(0)).persist()
            now = with_state(ends.select("monitor", F.col("last").alias("from_us"))).withColumn(
                "newer", F.col("last_us").isNull() | (F.col("from_us") > F.col("last_us"))).withColumn(
                "told", F.when(F.col("newer"), 0).otherwise(F.col("alerts")).cast("bigint")).withColumn(
                "due", F.greatest("told", floor_div(F.lit(clock - late) - F.col("from_us") - 1, step))).persist()
            held += [closed, now]
            open_and_closed = closed.select("monitor", "from_us", "told", "due").unionByName(
                now.select("monitor", "from_us", "told", "due"))
            inactive = open_and_closed.filter(F.col("due") > F.col("told")).select(
                "monitor", F.lit("inactive").alias("state"), (F.col("from_us") + (F.col("told") + 1) * step).alias("at_us"),
                ((F.col("told") + 1) * step).alias("silent_us"), (F.col("told") + 1).alias("alert"),
                (F.col("due") - F.col("told")).alias("repeats"))
            restored = closed.select(
                "monitor", F.lit("restored").alias("state"), F.col("to_us").alias("at_us"),
                (F.col("to_us") - F.col("from_us")).alias("silent_us"), F.greatest("due", "told").alias("alert"),
                F.lit(0).cast("bigint").alias("repeats"))
            inactive.unionByName(restored).write.mode("overwrite").parquet(f"{path}/messages/batch_id={batch_id}")
            changed = now.filter(F.col("newer") | (F.col("due") > F.col("told")))
            write_changes(changed.select("monitor", F.col("from_us").alias("last_us"), F.col("due").alias("alerts")),
                          state_path, batch_id, ["monitor"], buckets=buckets, unique=True)
        finally:
            for frame in held:
                frame.unpersist()

    return write


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a monitor."""
    return spark.read.schema(MONITOR_OUTPUT).parquet(f"{path}/messages").drop("batch_id")


def each_alert(messages: DataFrame, threshold: int = 45) -> DataFrame:
    """Messages with every repeated one as a row of its own."""
    step = threshold * 1_000_000
    rows = messages.withColumnsRenamed({"alert": "_first"}).select("*", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("repeats") - 1, F.lit(0)))).alias("_more"))
    return rows.select("monitor", "state", (F.col("at_us") + F.col("_more") * step).alias("at_us"),
                       (F.col("silent_us") + F.col("_more") * step).alias("silent_us"),
                       (F.col("_first") + F.col("_more")).alias("alert"))
