"""Writing rows out: topics, files, several sinks at once, previews."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.epoch import epoch_us, floor_div
from ..sources.schemas import struct_to_avsc


def json_value(df: DataFrame, keep_nulls: bool = False) -> Column:
    """All columns of a row as one JSON text."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                     {"ignoreNullFields": str(not keep_nulls).lower()})


def json_records(df: DataFrame, topic: str, key: Sequence[str] = (), headers: Mapping[str, str] | None = None,
                 keep_nulls: bool = False) -> DataFrame:
    """Rows as topic records: JSON value, optional JSON key, optional headers."""
    columns = [json_value(df, keep_nulls).cast("binary").alias("value"), F.lit(topic).alias("topic")]
    if key:
        columns.insert(0, F.to_json(F.struct(*key)).cast("binary").alias("key"))
    if headers:
        columns.append(header_column(headers))
    return df.select(*columns)


def header_column(headers: Mapping[str, str]) -> Column:
    """Headers from constants, or from columns where the value is ``col:<name>``."""
    entry = lambda n, v: F.struct(
        F.lit(n).alias("key"),
        (F.col(v[4:]).cast("string") if v.startswith("col:") else F.lit(v)).cast("binary").alias("value"))
    return F.array(*[entry(n, v) for n, v in headers.items()]).alias("headers")


def matching_headers(df: DataFrame, name_pattern: str) -> dict[str, str]:
    """Header settings for all columns whose name matches a regex such as ``schema.*``."""
    import re

    return {c: f"col:`{c}`" for c in df.columns if re.fullmatch(name_pattern, c)}


def avro_records(df: DataFrame, topic: str) -> DataFrame:
    """Rows as topic records with an Avro value (needs the Avro module on the class path)."""
    from pyspark.sql.avro.functions import to_avro

    avsc = struct_to_avsc(df.schema, topic)
    return df.select(to_avro(F.struct(*df.columns), avsc).alias("value"), F.lit(topic).alias("topic"))


def has_avro(spark) -> bool:
    """Whether the Avro module is on the class path."""
    try:
        return spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst") is not None
    except Exception:
        return False


def write_avro(df: DataFrame, path: str, schema: T.StructType, mode: str = "overwrite", fmt: str = "avro") -> None:
    """Rows in the given schema as Avro files, or as files of a format that the caller names."""
    if fmt == "avro" and not has_avro(df.sparkSession):
        raise RuntimeError("the Avro module is not on the class path")
    shaped = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    shaped.write.mode(mode).format(fmt).save(path)


def file_batch(path: str, fmt: str = "parquet", shape: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Sink that writes each micro-batch to a folder of its own, so a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def kafka_batch(servers: str, shape: Callable[[DataFrame], DataFrame] = lambda d: d, acks: str = "all"):
    """Sink that sends topic records to brokers."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (shape(batch).write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("kafka.acks", acks).save())
    return write


def fan_out(*sinks: Callable[[DataFrame, int], None], prepare: Callable[[DataFrame], DataFrame] = lambda d: d,
            skip_empty: bool = True) -> Callable[[DataFrame, int], None]:
    """One sink made of several: the micro-batch is computed once and written by each."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch).persist()
        try:
            if skip_empty and rows.isEmpty():
                return
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()
    return write


RETRY_LOG = "batch_id bigint, attempt int, outcome string, at_s double, next_s double, error string"


def retrying(sink: Callable[[DataFrame, int], None], path: str, attempts: int = 3,
             wait_s: Callable[[int], float] = lambda attempt: 5.0 * 2 ** attempt,
             now: Callable[[], float] = time.time) -> Callable[[DataFrame, int], None]:
    """A sink whose failed writes are kept and tried again, and do not stop the stream.

    The rows of a micro-batch that fails are written below ``path/rows``, and
    each attempt is a row of ``path/log`` with the time of the next one.  Every
    later micro-batch first tries what is due, under its own batch id, so a
    sink that replaces itself by batch id loses and doubles nothing.  After
    ``attempts`` failures a batch is a dead letter (:func:`dead_letters`).  Do
    not compact a keyed table beyond the oldest of :func:`waiting_batches`.
    """
    def attempt(rows: DataFrame, batch_id: int, number: int) -> None:
        spark = rows.sparkSession
        try:
            sink(rows, batch_id)
            outcome, error = "written", None
        except Exception as failure:  # whatever the sink raises is a failed write
            outcome, error = ("dead" if number >= attempts else "failed"), str(failure)[:2000]
            if number == 1:
                rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        if outcome != "written" or number > 1:
            line = (batch_id, number, outcome, now(), now() + wait_s(number), error)
            spark.createDataFrame([line], RETRY_LOG).coalesce(1).write.mode("overwrite").json(
                f"{path}/log/of={batch_id}/try={number}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for row in last_attempts(spark, path).filter("outcome = 'failed'").orderBy("batch_id").collect():
            if row["batch_id"] != batch_id and row["next_s"] <= now():
                attempt(spark.read.parquet(f"{path}/rows/batch_id={row['batch_id']}"), row["batch_id"], row["attempt"] + 1)
        attempt(batch, batch_id, 1)
    return write


def last_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The last attempt of each micro-batch that has failed; one row for each."""
    try:
        log = spark.read.schema(RETRY_LOG).json(f"{path}/log").select(*[c.split()[0] for c in RETRY_LOG.split(", ")])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RETRY_LOG)
    last = F.max_by(F.struct(*[c for c in log.columns if c != "batch_id"]), "attempt")
    return log.groupBy("batch_id").agg(last.alias("last")).select("batch_id", "last.*")


def waiting_batches(spark: SparkSession, path: str) -> list[int]:
    """Micro-batches that will be tried again."""
    return sorted(r["batch_id"] for r in last_attempts(spark, path).filter("outcome = 'failed'").collect())


def dead_letters(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that were given up, with ``batch_id`` and the ``error`` of the last attempt."""
    dead = last_attempts(spark, path).filter("outcome = 'dead'").select("batch_id", "error")
    if dead.isEmpty():
        return None
    return spark.read.parquet(f"{path}/rows").withColumn("batch_id", F.col("batch_id").cast("bigint")).join(dead, "batch_id")


def routed(outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
           sinks: Mapping[str, Callable[[DataFrame, int], None]], skip_empty: bool = True):
    """Sinks by the name of the route that feeds each."""
    def one(name: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            rows = outputs[name](batch)
            if not (skip_empty and rows.isEmpty()):
                sinks[name](rows, batch_id)
        return write
    return fan_out(*[one(name) for name in outputs], skip_empty=skip_empty)


def first_of_each_task(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of each task; the others are read to the end but not passed on.

    Spark's console sink takes all rows of a micro-batch to the driver, where it
    shows the first ones.
    """
    def first(batches):
        left = rows
        for batch in batches:
            if left:
                kept = batch.slice(0, left)
                left -= kept.num_rows
                yield kept
    return df.mapInArrow(first, df.schema)


def preview(df: DataFrame, time: str, every_ms: int, order: Sequence[str] = ()) -> DataFrame:
    """One row per interval (the first), or every row when the interval is 0.

    Each interval is folded to its first row before the shuffle.  A stream needs
    a watermark, and gives an interval once the watermark has passed its end.
    """
    if every_ms == 0:
        return df
    first = F.min_by(F.struct(*df.columns), F.struct(time, *order))
    if df.isStreaming:
        slot = F.window(time, f"{every_ms} milliseconds")
        return df.groupBy(slot).agg(first.alias("_row")).select("_row.*")
    slot = floor_div(epoch_us(time), every_ms * 1000)
    return df.groupBy(slot.alias("_slot")).agg(first.alias("_row")).select("_row.*")
