"""End-to-end jobs composed of the operators.

Each takes DataFrames that may be batches or streams; sinks are passed in as
functions ``(batch, batch id)``, see ``streaming.sinks`` and ``streaming.keyed``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import epoch, text
from ..operators import changes, joins, model, quality, reports, shape, timewindows, topics
from ..sources import records, schemas
from ..streaming import keyed, sinks, stateful, views

Sink = Callable[[DataFrame, int], None]


def edge_to_topic(source: DataFrame, topic_filter: str, limit: float = 500, max_age: int | None = 60,
                  ingest: str = "timestamp", schema_name: str = "SensorReading",
                  topic: str = "iot") -> tuple[DataFrame, DataFrame]:
    """Raw sensor messages: pick topics, extract two fields, drop bad and stale ones, tag, publish.

    Returns topic records, and the messages that lack both fields.
    """
    from ..sources.readers import topic_pattern

    picked = source.filter(topics.selected_topics(topic_pattern(topic_filter)))
    body = picked.withColumn("body", text.decode_bytes("value"))
    body = body.withColumns({
        "sensor_0": text.number_after_name("body", "sensor_0"),
        "sensor_1": text.number_after_name("body", "sensor_1"),
        "event_time": epoch.timestamp_from_us(text.json_value("body", "$.sensor_ts", "bigint")),
    })
    good, bad = records.split_valid_invalid(
        body, F.col("sensor_0").isNotNull() | F.col("sensor_1").isNotNull())
    good = quality.drop_implausible(good, limit=limit)
    if max_age is not None:
        good = quality.expire(good, ingest, "event_time", max_age)
    published = good.select(
        "key", F.col("body").cast("binary").alias("value"), F.lit(topic).alias("topic"),
        sinks.header_column({"schema.name": schema_name}))
    return published, bad.select("topic", "body")


def enrich(source: DataFrame, health: PipelineModel | None = None, default_result: Column | None = None,
           schema=schemas.READING_WIRE) -> tuple[DataFrame, DataFrame]:
    """Topic records to readings with a health flag, and unreadable records."""
    good, bad = records.parse_or_quarantine(source, schema, required=["sensor_id", "sensor_ts"])
    return with_health(good, health, default_result), bad


def with_health(rows: DataFrame, health: PipelineModel | None = None,
                default_result: Column | None = None) -> DataFrame:
    """Health flag from the model where there is one, else from the record's own response or a default."""
    if health is not None:
        numbered = rows.withColumns({str(i): F.col(c).cast("double") for i, c in enumerate(schemas.SENSOR_COLUMNS)})
        scored = model.score(health, numbered, "_result").drop("p_healthy", *[str(i) for i in range(12)])
        rows = shape.insert_record(scored, "response", {"result": F.col("_result")}).drop("_result")
    else:
        default = default_result if default_result is not None else text.stub_result(["sensor_id", "sensor_ts"])
        rows = shape.fill_nested(rows, "response.result", default)
    return shape.assign_path(rows, "is_healthy", "response.result")


def reading_table_rows(enriched: DataFrame, schema=schemas.READING_TABLE) -> DataFrame:
    """Enriched readings in the columns and types of the stored table."""
    return enriched.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def enriched_sink(table_path: str, json_path: str, avro_path: str, failures: Sink | None = None,
                  health: PipelineModel | None = None, default_result: Column | None = None,
                  avro_format: str = "avro", buckets: int = keyed.HASH_PARTITIONS, monitor: Sink | None = None,
                  wire=schemas.READING_WIRE, stored=schemas.READING_TABLE) -> Sink:
    """Topic records to: keyed table, JSON topic folder, Avro folder, monitor, and quarantine, from one pass.

    Of several readings of one key in a batch the one with the greatest values
    is stored, so a repeated batch stores the same.  ``avro_format`` names
    another file format where the Avro module is missing.  ``wire`` and
    ``stored`` are the schemas of the records and of the table, such as those of
    the readings with a place.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = records.parse_json(batch, wire).persist()
        try:
            good, bad = records.split_parsed(parsed, ["sensor_id", "sensor_ts"])
            sinks.fan_out(store, publish, avro, *([monitor] if monitor else []))(with_health(good, health, default_result), batch_id)
            if failures:
                failures(bad, batch_id)
        finally:
            parsed.unpersist()

    keys = schemas.TABLE_KEYS["sensors"]
    rest = [f.name for f in stored if f.name not in keys]
    store = keyed.upsert(table_path, keys, rest, buckets, shape=lambda d: reading_table_rows(d, stored))
    publish = sinks.file_batch(json_path, shape=lambda d: sinks.json_records(d, "iot_enriched"))

    def avro(d: DataFrame, n: int) -> None:
        sinks.write_avro(d, f"{avro_path}/batch_id={n}", wire, fmt=avro_format)

    return write


def sensor_statistics(rows: DataFrame, size: str = "30 seconds", slide: str = "1 second",
                      threshold: float = 70) -> DataFrame:
    """Plausible readings over sliding windows, per device."""
    stats = timewindows.sliding_stats(quality.drop_implausible(rows), ["sensor_id"], "sensor_6", "event_time",
                                      size, slide, threshold)
    return stats.withColumnRenamed("sensor_id", "device_id")


def statistics_view(path: str, ignore_nulls: bool = True) -> Sink:
    """Sink that keeps the last window of every device."""
    return views.view_sink(path, ["device_id"], ["windowEnd"], ignore_nulls)


def score_payments(lines: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Text lines to payments with the scorer's answer under ``model_response``; see :func:`rejected_payments`."""
    rows = records.parse_json_flat(lines, schemas.TRANSACTION_RAW)
    return scorer(shape.tag(rows, schema__name="Transaction"))


def rejected_payments(lines: DataFrame) -> DataFrame:
    """The lines that are no payments, with their text and a reason, for quarantine."""
    return records.unreadable(lines, schemas.TRANSACTION_RAW)


def payment_routes(threshold: float = 0.90) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The three outputs of a scored payment."""
    score = F.col("model_response.fraud_score").alias("fraud_score")
    flat = lambda d, account="account_id": d.select(
        "ts", F.col("account_id").alias(account), "transaction_id", "amount", "lat", "lon", score)
    return {
        "flattened": flat,
        "to_kudu": lambda d: shape.cast_columns(flat(d, "acc_id"), {"amount": "bigint"}),
        "likely_fraud": lambda d: quality.above_score(flat(d), "fraud_score", threshold),
    }


def by_number(column: str) -> list[Column]:
    """Order of numbers that stand as text: longer ones come later."""
    return [F.length(column), F.col(column)]


def payments_sink(transactions_path: str, suspects_path: str, table_path: str, threshold: float = 0.90,
                  buckets: int = keyed.HASH_PARTITIONS, retry_path: str | None = None, **retry) -> Sink:
    """Scored payments to two topic folders and the keyed table.

    With ``retry_path`` the writes of each that fail are kept there and tried again.
    """
    outputs = {
        "flattened": sinks.file_batch(transactions_path, shape=lambda d: sinks.json_records(d, "transactions")),
        "to_kudu": keyed.upsert(table_path, schemas.TABLE_KEYS["transactions"], buckets=buckets, by=by_number("transaction_id")),
        "likely_fraud": sinks.file_batch(suspects_path, shape=lambda d: sinks.json_records(d, "fraud_suspects")),
    }
    if retry_path:
        outputs = {name: sinks.retrying(sink, f"{retry_path}/{name}", **retry) for name, sink in outputs.items()}
    return sinks.routed(payment_routes(threshold), outputs)


def fraud_sink(topic_path: str, table_path: str, buckets: int = keyed.HASH_PARTITIONS) -> Sink:
    """Found frauds to the topic folder and the keyed table, computed once."""
    return sinks.fan_out(
        sinks.file_batch(topic_path, shape=lambda d: sinks.json_records(joins.fraud_topic_rows(d), "fraudulent_txn")),
        keyed.upsert(table_path, schemas.TABLE_KEYS["fraudulent_txn"], buckets=buckets,
                     shape=joins.fraud_table_rows, by=by_number("transaction_id")),
    )


def replica_sink(table_path: str, log_path: str | None = None, keys: tuple[str, ...] = ("id",),
                 buckets: int = keyed.HASH_PARTITIONS) -> Sink:
    """Change events (``op, before, after, ts, seq``) to a replica table and, if asked, a change log."""
    def replica(batch: DataFrame, batch_id: int) -> None:
        state = changes.apply_changes(batch, keys, ["ts", "seq"], keep_deleted=True)
        keyed.write_changes(state, table_path, batch_id, keys, buckets=buckets, unique=True)

    def log(batch: DataFrame, batch_id: int) -> None:
        events = changes.encode(batch, ["ts", "seq"])
        changes.to_change_json(events, keys).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
    return sinks.fan_out(replica, log) if log_path else replica


def read_replica(spark, table_path: str, keys: tuple[str, ...] = ("id",)) -> DataFrame | None:
    rows = keyed.read_keyed(spark, table_path, keys, ["ts", "seq"])
    return None if rows is None else rows.drop("ts", "seq")


def train_and_choose(frame: DataFrame, path: str | None = None, seed: int = 0, settings=model.EXPERIMENTS, **options):
    """Split, try the settings, keep and save the best model; returns metrics and model."""
    train, test = (model.spread(part) for part in model.split_frame(frame, 0.7, seed))
    try:
        return model.experiments(train, test, settings, path=path, **options)
    finally:
        train.unpersist()
        test.unpersist()


def dashboard(rows: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The report queries over the readings table."""
    timed = rows.withColumn("sensor_timestamp", epoch.timestamp_from_us("sensor_ts"))
    return {
        "likely_to_break": rows.filter("is_healthy = 0").select("sensor_id", "sensor_ts"),
        "health_counts": reports.count_by(rows, ["is_healthy"]),
        "row_count": reports.row_count(rows),
        "newest": reports.newest(rows, ["sensor_ts", "sensor_id"]),
        "averages": reports.newest(
            reports.average_by(timed, ["sensor_timestamp", "sensor_id"], ["sensor_0", "sensor_1"]),
            ["sensor_timestamp", "sensor_id"]),
        "last_minute": reports.average_last_minute(
            timed.withColumn("event_time", F.col("sensor_timestamp")), as_of),
    }


def watch_readings(path: str, threshold: int = 45, **options) -> Sink:
    """Inactivity messages for the whole stream of readings."""
    watch = stateful.monitor_sink(path, threshold, **options)
    return lambda d, n: watch(d.withColumn("event_time", epoch.timestamp_from_us("sensor_ts")), n)
