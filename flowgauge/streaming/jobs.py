"""Named long-running jobs: start, list, stop, resume."""

from __future__ import annotations

import datetime
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import new_folder
from . import sinks


def start_job(
    df: DataFrame,
    name: str,
    *,
    fmt: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    table: str | None = None,
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = "5 seconds",
    **options,
) -> StreamingQuery:
    """Start a streaming query under a name.

    Given the checkpoint folder of an earlier run the job goes on where that
    one stopped; without one it starts afresh in a new folder.  ``every=None``
    reads what is there now and stops.  A console is sent the rows of each task
    that it may show, and no others.
    """
    if fmt == "console":
        df = sinks.first_of_each_task(df, int(options.get("numRows", 20)) + 1)
    writer = (
        df.writeStream.queryName(name).outputMode(mode).options(**options)
        .option("checkpointLocation", checkpoint or new_folder(df.sparkSession, f"checkpoint-{name}"))
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if each_batch:
        return writer.foreachBatch(each_batch).start()
    if table:
        return writer.format(fmt or "parquet").toTable(table)
    writer = writer.format(fmt or "parquet")
    return writer.start(path) if path else writer.start()


def run_available(df: DataFrame, name: str, **kwargs) -> None:
    """Process what is there now, and wait for the end."""
    start_job(df, name, every=None, **kwargs).awaitTermination()


def list_jobs(spark: SparkSession, running: bool | None = None) -> list[str]:
    """Names of active jobs; ``running=False`` lists those waiting for data."""
    jobs = [q for q in spark.streams.active if q.name]
    if running is not None:
        jobs = [q for q in jobs if q.status["isTriggerActive"] == running]
    return sorted(q.name for q in jobs)


def stop_job(spark: SparkSession, name: str) -> bool:
    """Stop a job by name; its checkpoint stays for a later start."""
    for q in spark.streams.active:
        if q.name == name:
            q.stop()
            return True
    return False


HISTORY = ("job string, run_id string, event string, batch_id bigint, at timestamp, duration_ms bigint, rows bigint, "
           "late_groups bigint, state_rows bigint, error string")


class JobHistory(StreamingQueryListener):
    """Listener that writes a row for the start, each micro-batch and the end of every job below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}
        self.writing, self.ended = threading.Lock(), threading.Condition()
        self.over: set[str] = set()

    def _write(self, row: tuple) -> None:
        # A folder for each run, and one write at a time: appends to one folder at once would lose rows.
        with self.writing:
            self.spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").json(f"{self.path}/of={row[1]}")

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self._write((event.name, str(event.runId), "started", None, _moment(event.timestamp), None, None, None, None, None))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        operators = p.stateOperators or []
        self._write((p.name, str(p.runId), "batch", p.batchId, _moment(p.timestamp), p.batchDuration, p.numInputRows,
                     sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in operators), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        ended = "failed" if event.exception else "stopped"
        self._write((self.names.get(run), run, ended, None, datetime.datetime.now(datetime.timezone.utc), None, None, None, None,
                     event.exception and event.exception[:2000]))
        with self.ended:
            self.over.add(self.names.get(run, run))
            self.ended.notify_all()

    def wait_for(self, names: Sequence[str], seconds: float = 60) -> bool:
        """Wait until the ends of these jobs are written, as events come some time after they happen."""
        with self.ended:
            return self.ended.wait_for(lambda: self.over >= set(names), seconds)


def _moment(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))


def history(spark: SparkSession, path: str) -> DataFrame:
    """All rows that a :class:`JobHistory` has written."""
    return spark.read.schema(HISTORY).json(path).drop("of")


def job_states(rows: DataFrame) -> DataFrame:
    """One row per job: state of its last run (started, stopped or failed), its micro-batches and rows, and the error."""
    order = F.struct("at", F.when(F.col("event") == "started", 0).when(F.col("event") == "batch", 1).otherwise(2))
    per_run = rows.groupBy("job", "run_id").agg(
        F.min("at").alias("began"), F.max_by(F.when(F.col("event") != "batch", F.col("event")),
                                             F.when(F.col("event") != "batch", order)).alias("state"),
        F.count_if(F.col("event") == "batch").alias("batches"), F.sum("rows").alias("rows"), F.max("error").alias("error"))
    last = F.max_by(F.struct("state", "batches", "rows", "error"), "began").alias("last")
    return per_run.groupBy("job").agg(F.count(F.lit(1)).alias("runs"), last).select("job", "runs", "last.*")


def cadence(rows: DataFrame) -> DataFrame:
    """Seconds from the start of one micro-batch to that of the next, per run."""
    before = F.lag("at").over(Window.partitionBy("run_id").orderBy("batch_id", "at"))
    seconds = (F.unix_micros("at") - F.unix_micros(before)) / 1_000_000
    return rows.filter("event = 'batch'").select("job", "run_id", "batch_id", "at", seconds.alias("seconds")).filter("seconds IS NOT NULL")


def state_rows(spark: SparkSession, checkpoint: str, side: str | None = None, operator: int = 0,
               batch_id: int | None = None) -> DataFrame:
    """The state that a job holds, as a table (``key, value, partition_id``); ``side`` of a stream join: left or right."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if side:
        reader = reader.option("joinSide", side)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)
