"""Queries for sources, sinks, keyed tables and streaming jobs.

Each writes what it needs from the whole test tables to a fresh place in the
shared folder and reads it back the way the operator does.  Streams read the
tables as arriving files and stop when all are processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import epoch
from ..operators import changes, joins, timewindows
from ..session import new_folder
from ..sources import catalog, readers, records as rec, schemas
from ..streaming import jobs, keyed, sinks, stateful, views
from . import inputs, pipelines
from .queries_analytics import (CHANGES, COUNT_WINDOWS, CUSTOMERS, FRAUDS, GAP, LATEST_STATS, NEW, ORDER, PLAUSIBLE,
                                RUNNING, STATS, _changes, _customers, shown, sliding_sql)
from .queries_values import _readings, _records, _transactions
from .registry import READINGS, RECORD_TEXT, RECORDS, SENSOR_LIST, TRANSACTIONS, query, with_


SALTED_ROWS = 500_000  # of a micro-batch at most where a join keeps each row several times


def _written(df: DataFrame, name: str, fmt: str = "parquet") -> str:
    path = new_folder(df.sparkSession, name)
    df.write.format(fmt).save(path)
    return path


def _topic(spark: SparkSession, sf: str) -> dict:
    """A file provider that holds the readings as topic records."""
    return {"type": "files", "path": _written(_records(spark, sf), "topic")}


def _event_stream(spark: SparkSession, sf: str, most: int | None = None) -> DataFrame:
    """The events in time order, over four micro-batches, or more where one would have more than ``most`` rows."""
    return inputs.feed(spark, sf, "events", "ts", new_folder(spark, "feed"), 4, most=most)


def _collected(df: DataFrame, name: str, **options) -> DataFrame:
    """Run a stream over what is there, into a folder, and read that folder."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    jobs.run_available(df, name, path=path, **options)
    return spark.read.schema(df.schema).parquet(path)


# --- sources --------------------------------------------------------------

@query("src01_topic_scan", with_(RECORDS) + """
SELECT key, topic, "partition", "offset", "timestamp" FROM records WHERE topic = 'iot/click'""")
def src01(spark, sf):
    rows = readers.read_topic(spark, _topic(spark, sf), "iot/click", start="earliest", stream=False)
    return rows.select(F.decode("key", "UTF-8").alias("key"), "topic", "partition", "offset",
                       epoch.naive("timestamp").alias("timestamp"))


@query("src01_topic_stream", with_(RECORDS) + """
SELECT key, topic, "partition", "offset" FROM records WHERE topic = 'iot/click'""")
def src01_stream(spark, sf):
    rows = readers.read_topic(spark, _topic(spark, sf), "iot/click", start="earliest")
    return _collected(rows.select(F.decode("key", "UTF-8").alias("key"), "topic", "partition", "offset"), "src01")


@query("src02_decode_and_parse_json", with_(RECORDS) + f"""
SELECT sensor_id, sensor_ts, result, {SENSOR_LIST} FROM records""")
def src02(spark, sf):
    rows = rec.parse_json_flat(_records(spark, sf), schemas.READING_WIRE)
    return rows.select("sensor_id", "sensor_ts", F.col("response.result").alias("result"), *schemas.SENSOR_COLUMNS)


@query("src03_registered_table", with_(RECORDS) + """
SELECT sensor_id, (sensor_ts + 500) // 1000 AS sensor_ts, make_timestamp(((sensor_ts + 500) // 1000) * 1000) AS event_time
FROM records WHERE topic = 'iot/view'""")
def src03(spark, sf):
    to_ms = lambda d: d.withColumn("sensor_ts", epoch.rescale_epoch("sensor_ts", "us", "ms"))
    catalog.register_stream_table(
        spark, "fg_iot_enriched", _topic(spark, sf), "iot/view", schemas.READING_WIRE, transform=to_ms,
        event_time=F.timestamp_millis("sensor_ts"), start="earliest", stream=False)
    return spark.sql("SELECT sensor_id, sensor_ts, CAST(event_time AS timestamp_ntz) AS event_time FROM fg_iot_enriched")


@query("src04_table_from_ddl", with_(TRANSACTIONS) + """
SELECT epoch_us(date_trunc('second', event_time)) // 1000 AS ts, account_id, transaction_id, amount, lat, lon,
       date_trunc('second', event_time) AS event_time FROM transactions""")
def src04(spark, sf):
    lines = inputs.raw_transactions(inputs.load(spark, sf, "events"))
    rows = rec.parse_json_flat(lines, schemas.TRANSACTION_RAW).withColumn("ts", epoch.text_to_epoch_ms("ts"))
    catalog.register_rows(rows, "fg_transactions", event_time=epoch.timestamp_from_ms_floored("ts"))
    return spark.table("fg_transactions").withColumn("event_time", epoch.naive("event_time"))


@query("src05_start_position", with_(RECORDS) + """
SELECT topic, "partition", "offset" FROM records WHERE "timestamp" >= TIMESTAMP '2024-01-15'""")
def src05(spark, sf):
    return readers.start_at(_records(spark, sf), "2024-01-15 00:00:00").select("topic", "partition", "offset")


@query("src06_detect_schema", """
SELECT DISTINCT k AS field, CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' END AS type
FROM (SELECT props, unnest(json_keys(props)) AS k FROM events)""")
def src06(spark, sf):
    found = rec.detect_schema(inputs.load(spark, sf, "events"), "props")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "field string, type string")


@query("src07_schema_from_avro_text", with_(RECORDS) + "SELECT sensor_id, sensor_ts, result, sensor_11 FROM records")
def src07(spark, sf):
    schema = schemas.avsc_to_struct(schemas.struct_to_avsc(schemas.READING_WIRE, "SensorReading"))
    rows = rec.parse_json_flat(_records(spark, sf), schema)
    return rows.select("sensor_id", "sensor_ts", F.col("response.result").alias("result"), "sensor_11")


@query("src08_filtered_catalog", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'nation', count(*) FROM nation""")
def src08(spark, sf):
    names = ["orders", "nation", "region", "supplier", "part", "events"]
    listed = {n: (inputs.load(spark, sf, n).schema, f"{sf}/{n}.parquet") for n in names}
    chosen = catalog.register_catalog(spark, listed, table_filter="o.*|na.*")
    counts = [spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n in chosen]
    return counts[0].unionByName(counts[1])


@query("src09_schema_by_header", with_(RECORDS) + """
SELECT schema_name, sensor_id, sensor_ts FROM records""")
def src09(spark, sf):
    parts = rec.parse_by_schema_name(
        _records(spark, sf),
        {"SensorReading": schemas.READING_WIRE, "TransactionEvent": "sensor_id int, sensor_ts bigint"},
        rec.header_value(r"schema\.name"))
    columns = ["schema_name", "sensor_id", "sensor_ts"]
    return parts["SensorReading"].select(columns).unionByName(parts["TransactionEvent"].select(columns))


@query("src10_older_schema_under_newer", with_(READINGS) + """
SELECT reading_id, sensor_0, CAST(NULL AS VARCHAR) AS city FROM readings
UNION ALL SELECT reading_id, sensor_0, 'city-' || sensor_2 FROM readings""")
def src10(spark, sf):
    old = _readings(spark, sf).select("reading_id", "sensor_0")
    city = F.concat(F.lit("city-"), F.col("sensor_2").cast("string"))
    new = _readings(spark, sf).select("reading_id", "sensor_0", city.alias("city"))
    return rec.read_as_newest([new, old])


TRAINING_SQL = """SELECT CAST(sensor_0 AS DOUBLE) AS "0", CAST(sensor_1 AS DOUBLE) AS "1", CAST(sensor_11 AS DOUBLE) AS "11",
 CASE WHEN sensor_1 > 40 AND sensor_3 > 30 THEN 0 ELSE 1 END AS "12" FROM readings"""


@query("src11_csv_with_schema", with_(READINGS) + TRAINING_SQL)
def src11(spark, sf):
    path = _written(inputs.training_frame(inputs.load(spark, sf, "events")), "csv", "csv")
    return readers.read_csv(spark, path, schemas.TRAINING_FRAME).select("0", "1", "11", "12")


@query("src12_change_source", with_(CHANGES) + """
SELECT op, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM (
  SELECT 'r' AS op, c_custkey AS id FROM customer UNION ALL SELECT op, id FROM changes) GROUP BY op""")
def src12(spark, sf):
    table = inputs.load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    zero = F.lit(0).cast("bigint")
    log = readers.read_folder(spark, _written(_changes(spark, sf), "changes"), _changes(spark, sf).schema)
    rows = changes.snapshot_then_changes(table, log, zero, zero)
    return rows.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("after.id", "before.id")).alias("ids"))


@query("src14_table_by_name", with_(CUSTOMERS) + "SELECT * FROM customers")
def src14(spark, sf):
    _customers(spark, sf).createOrReplaceTempView("fg_customers")
    return spark.table("fg_customers")


@query("src15_wildcard_topics", with_(RECORDS) + "SELECT topic, count(*) AS n FROM records GROUP BY topic")
def src15(spark, sf):
    rows = readers.read_topic(spark, _topic(spark, sf), readers.topic_pattern("iot/#"), pattern=True,
                              start="earliest", stream=False)
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("src16_json_lines_stream", with_(TRANSACTIONS) + """
SELECT account_id, transaction_id, amount, lat, lon FROM transactions""")
def src16(spark, sf):
    path = _written(inputs.raw_transactions(inputs.load(spark, sf, "events")), "lines", "text")
    rows = rec.parse_json_flat(readers.read_lines(spark, path, stream=True), schemas.TRANSACTION_RAW)
    return _collected(rows.drop("ts"), "src16")


@query("src17_replace_dimension_rows", with_(CUSTOMERS) + "SELECT acc_id, card FROM customers WHERE gender = 'F'")
def src17(spark, sf):
    path = _written(_customers(spark, sf), "dimension")
    catalog.replace_rows(_customers(spark, sf).filter("gender = 'F'"), path)
    return spark.read.parquet(path).select("acc_id", "card")


@query("src18_json_array_messages", with_(READINGS) + """
SELECT sensor_id, sensor_ts, sensor_9 FROM readings UNION ALL SELECT sensor_id, sensor_ts + 1, sensor_10 FROM readings
WHERE reading_id % 2 = 0""")
def src18(spark, sf):
    one = lambda ts, v: F.struct("sensor_id", ts.alias("sensor_ts"), F.col(v).alias("sensor_9"))
    first, second = one(F.col("sensor_ts"), "sensor_9"), one(F.col("sensor_ts") + 1, "sensor_10")
    message = F.when(F.col("reading_id") % 2 == 0, F.to_json(F.array(first, second))).otherwise(F.to_json(first))
    messages = _readings(spark, sf).select(message.alias("value"))
    return rec.parse_json_array(messages, "sensor_id int, sensor_ts bigint, sensor_9 int")[0].select("data.*")


@query("src19_named_provider", with_(RECORDS) + """SELECT "partition", count(*) AS n FROM records WHERE topic = 'iot/error' GROUP BY 1""")
def src19(spark, sf):
    readers.create_provider("fg-local", "files", path=_topic(spark, sf)["path"])
    rows = readers.read_topic(spark, "fg-local", "iot/error", start="earliest", stream=False)
    return rows.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


@query("src20_table_metadata", """
SELECT column_name AS col_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
       WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type
FROM (DESCRIBE SELECT * FROM orders) AS d(column_name, data_type)""".replace(
    "(DESCRIBE SELECT * FROM orders) AS d(column_name, data_type)",
    "information_schema.columns WHERE table_name = 'orders'"))
def src20(spark, sf):
    inputs.load(spark, sf, "orders").createOrReplaceTempView("fg_orders")
    return catalog.table_info(spark, "fg_orders").filter("col_name <> '' AND col_name NOT LIKE '#%'").select("col_name", "data_type")


@query("src21_dropped_csv_files_stream", with_(READINGS) + TRAINING_SQL)
def src21(spark, sf):
    path = _written(inputs.training_frame(inputs.load(spark, sf, "events")), "csv", "csv")
    rows = readers.read_csv(spark, path, schemas.TRAINING_FRAME, stream=True)
    return _collected(rows.select("0", "1", "11", "12"), "src21")


# --- sinks ----------------------------------------------------------------

@query("snk02_publish_avro", with_(READINGS) + f"""
SELECT sensor_id, sensor_ts, is_healthy, {SENSOR_LIST} FROM readings""")
def snk02(spark, sf):
    path = new_folder(spark, "avro")
    rows = _readings(spark, sf).withColumn("response", F.struct(F.col("is_healthy").alias("result")))
    fmt = "avro" if sinks.has_avro(spark) else "parquet"
    sinks.write_avro(rows, path, schemas.READING_WIRE, fmt=fmt)
    return spark.read.format(fmt).load(path).drop("response")


@query("snk09_preview_stream", with_(READINGS) + """
SELECT * EXCLUDE (event_time), event_time FROM readings WHERE reading_id IN (
  SELECT arg_min(reading_id, (event_time, reading_id)) FROM readings GROUP BY date_trunc('day', event_time)
  HAVING date_trunc('day', min(event_time)) + INTERVAL 1 DAY <= (SELECT max(event_time) - INTERVAL 3 SECOND FROM readings))""")
def snk09_stream(spark, sf):
    rows = inputs.readings(inputs.feed(spark, sf, "events", "ts", new_folder(spark, "feed")))
    shown = sinks.preview(rows.withWatermark("event_time", "3 seconds"), "event_time", 86_400_000, ["reading_id"])
    return _collected(shown, "snk09").withColumn("event_time", epoch.naive("event_time"))


@query("snk03_insert_from_stream", with_(READINGS) + "SELECT sensor_id, sensor_6 FROM readings")
def snk03(spark, sf):
    rows = inputs.readings(_event_stream(spark, sf)).select("sensor_id", "sensor_6")
    return _collected(rows, "snk03")


@query("snk04_one_view_two_sinks", with_(READINGS) + """
SELECT 'topic' AS sink, count(*) AS n, CAST(sum(sensor_0) AS BIGINT) AS total FROM readings
UNION ALL SELECT 'table', count(*), CAST(sum(sensor_0) AS BIGINT) FROM
  (SELECT sensor_id, sensor_ts, max(sensor_0) AS sensor_0 FROM readings GROUP BY 1, 2)""")
def snk04(spark, sf):
    topic, table = new_folder(spark, "topic"), new_folder(spark, "table")
    keys = ["sensor_id", "sensor_ts"]
    rows = inputs.readings(_event_stream(spark, sf)).select(*keys, "sensor_0")
    jobs.run_available(rows, "snk04", each_batch=sinks.fan_out(
        sinks.file_batch(topic, shape=lambda d: sinks.json_records(d, "out", ["sensor_id"])),
        keyed.upsert(table, keys, ["sensor_0"])))
    published = rec.parse_json_flat(spark.read.parquet(topic), "sensor_0 int")
    stored = keyed.read_keyed(spark, table, keys)
    total = lambda d, name: d.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n"), F.sum("sensor_0").alias("total"))
    return total(published, "topic").unionByName(total(stored, "table"))


LAST = """last_rows AS (SELECT sensor_id, arg_max(sensor_0, (sensor_ts, reading_id)) AS sensor_0, max(sensor_ts) AS sensor_ts
  FROM readings GROUP BY 1)"""


@query("snk05_keyed_upsert", with_(READINGS, LAST) + "SELECT * FROM last_rows")
def snk05(spark, sf):
    path = new_folder(spark, "upsert")
    rows = _readings(spark, sf).select("sensor_id", "sensor_0", "sensor_ts", "reading_id")
    cut = F.unix_micros(F.lit("2024-01-15 00:00:00").cast("timestamp"))
    keyed.write_changes(rows.filter(F.col("sensor_ts") < cut), path, 0, ["sensor_id"], ORDER)
    keyed.compact(spark, path, ["sensor_id"], upto=0)
    keyed.write_changes(rows.filter(F.col("sensor_ts") >= cut), path, 1, ["sensor_id"], ORDER)
    return keyed.read_keyed(spark, path, ["sensor_id"]).drop("reading_id")


@query("snk05_keyed_upsert_stream", with_(READINGS, LAST) + "SELECT * FROM last_rows")
def snk05_stream(spark, sf):
    path = new_folder(spark, "upsert")
    rows = inputs.readings(_event_stream(spark, sf)).select("sensor_id", "sensor_0", "sensor_ts", "reading_id")
    jobs.run_available(rows, "snk05", each_batch=keyed.upsert(path, ["sensor_id"], ORDER))
    return keyed.read_keyed(spark, path, ["sensor_id"], ORDER).drop("reading_id")


@query("snk06_hash_partitions", with_(CUSTOMERS) + """
SELECT acc_id, CAST(1 AS BIGINT) AS buckets, true AS within FROM (SELECT DISTINCT acc_id FROM customers)""")
def snk06(spark, sf):
    path = new_folder(spark, "buckets")
    keyed.with_bucket(_customers(spark, sf), ["acc_id"]).write.partitionBy("bucket").parquet(path)
    inside = F.col("bucket").between(0, schemas.HASH_PARTITIONS - 1)
    return spark.read.parquet(path).groupBy("acc_id").agg(
        F.countDistinct("bucket").alias("buckets"), F.bool_and(inside).alias("within"))


@query("snk10_quarantine", with_(RECORDS) + f"""
SELECT CASE WHEN event_id % 11 = 0 THEN 'unreadable' ELSE 'missing field' END AS reason,
       CASE WHEN event_id % 11 = 0 THEN substr(text, 2) ELSE '{{}}' END AS decoded
FROM (SELECT event_id, {RECORD_TEXT} AS text FROM records) WHERE event_id % 11 = 0 OR event_id % 13 = 0""")
def snk10(spark, sf):
    number = F.col("offset") * 10 + F.col("partition")
    body = F.decode("value", "UTF-8")
    damaged = F.when(number % 11 == 0, F.substr(body, F.lit(2))).when(number % 13 == 0, F.lit("{}")).otherwise(body)
    _, bad = rec.parse_or_quarantine(_records(spark, sf).select(damaged.alias("value")), schemas.READING_WIRE,
                                     required=["sensor_id"])
    return bad.select("reason", "decoded")


@query("snk12_table_life_cycle", "SELECT count(*) AS n FROM supplier")
def snk12(spark, sf):
    table = inputs.load(spark, sf, "supplier")
    path = new_folder(spark, "life")
    catalog.drop_table(spark, "fg_supplier")
    catalog.create_table(spark, "fg_supplier", table.schema, path)
    catalog.create_table(spark, "fg_supplier", table.schema, path)
    table.write.insertInto("fg_supplier")
    catalog.drop_table(spark, "fg_supplier")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


# --- streams --------------------------------------------------------------

# A window is given out once the watermark, three seconds before the newest
# whole-millisecond event time, has reached its end.
CLOSED = """HAVING w + INTERVAL 30 SECOND <= (SELECT max(date_trunc('millisecond', event_time)) FROM readings) - INTERVAL 3 SECOND"""


@query("str03_sliding_statistics_stream", with_(READINGS) + sliding_sql("device_id", PLAUSIBLE, CLOSED))
def str03_stream(spark, sf):
    rows = inputs.readings(_event_stream(spark, sf)).withWatermark("event_time", "3 seconds")
    found = _collected(pipelines.sensor_statistics(rows), "str03")
    return found.withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str06_tumbling_sum_stream", with_(READINGS) + """
SELECT sensor_id, w + INTERVAL 10 SECOND AS "windowEnd", CAST(sum(sensor_0) AS BIGINT) AS total
FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, event_time) AS w FROM readings)
GROUP BY sensor_id, w HAVING w + INTERVAL 10 SECOND <= (SELECT max(date_trunc('millisecond', event_time)) FROM readings) - INTERVAL 3 SECOND""")
def str06_stream(spark, sf):
    rows = inputs.readings(_event_stream(spark, sf))
    timed = timewindows.with_event_time(rows, epoch.timestamp_from_us("sensor_ts"))
    return _collected(timewindows.tumbling_sum(timed), "str06").withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str07_str08_count_windows_stream", COUNT_WINDOWS)
def str07(spark, sf):
    path = new_folder(spark, "count-windows")
    rows = inputs.readings(_event_stream(spark, sf))
    jobs.run_available(rows, "str07", each_batch=stateful.count_window_sink(
        path, ["sensor_id"], ORDER, "sensor_9", 3, ["reading_id"]))
    return spark.read.parquet(f"{path}/windows").drop("batch_id")


@query("str09_running_sum_stream", f"SELECT * FROM ({RUNNING}) WHERE sensor_0 >= 50")
def str09(spark, sf):
    path = new_folder(spark, "running")
    rows = inputs.readings(_event_stream(spark, sf))
    jobs.run_available(rows, "str09", each_batch=stateful.running_sum_sink(
        path, ["sensor_id"], ORDER, "sensor_0", keep=lambda d: d.filter("sensor_0 >= 50")))
    return spark.read.parquet(f"{path}/rows").select("reading_id", "sensor_id", "sensor_0", "running_sum")


@query("str10_latest_state_stream", with_(READINGS) + """
SELECT sensor_id, arg_max(reading_id, (sensor_ts, reading_id)) AS reading_id, max(sensor_ts) AS sensor_ts,
       arg_max(sensor_0, (sensor_ts, reading_id)) AS sensor_0 FROM readings GROUP BY 1""")
def str10_stream(spark, sf):
    path = new_folder(spark, "view")
    rows = inputs.readings(_event_stream(spark, sf)).select("sensor_id", "reading_id", "sensor_ts", "sensor_0")
    jobs.run_available(rows, "str10", each_batch=views.view_sink(path, ["sensor_id"], ORDER))
    return views.read_view(spark, path, ["sensor_id"], ORDER)


MONITOR_SQL = f"""
SELECT monitor, 'restored' AS state, epoch_us(restored_at) AS at_us, gap_us AS silent_us, alerts AS alert, CAST(0 AS BIGINT) AS repeats
FROM ({{gaps}})
UNION ALL
SELECT monitor, 'inactive', epoch_us(restored_at) - gap_us + 45000000, CAST(45000000 AS BIGINT), CAST(1 AS BIGINT), alerts
FROM ({{gaps}})"""


def told(messages: DataFrame) -> DataFrame:
    """The messages, with those that a gap was told in taken together; gaps that are still open are left out."""
    start = (F.col("at_us") - F.col("silent_us")).alias("from_us")
    ended = messages.filter("state = 'restored'").select("monitor", start)
    inactive = messages.filter("state = 'inactive'").select("*", start).join(ended, ["monitor", "from_us"]).groupBy(
        "monitor", "state", "from_us").agg(F.min("at_us").alias("at_us"), F.min("silent_us").alias("silent_us"),
                                           F.min("alert").alias("alert"), F.sum("repeats").alias("repeats")).drop("from_us")
    return messages.filter("state = 'restored'").unionByName(inactive)


@query("str14_inactivity_monitor_stream", with_(READINGS) + MONITOR_SQL.format(
    gaps=f"SELECT 'all' AS monitor, * FROM ({GAP.format(keys='', part='')})"))
def str14(spark, sf):
    path = new_folder(spark, "monitor")
    rows = inputs.readings(_event_stream(spark, sf))
    jobs.run_available(rows, "str14", each_batch=stateful.monitor_sink(path))
    return told(stateful.read_messages(spark, path))


@query("str14_inactivity_monitor_per_key_stream", with_(READINGS) + MONITOR_SQL.format(
    gaps="SELECT CAST(sensor_id AS VARCHAR) AS monitor, * FROM (" + GAP.format(keys="sensor_id, ", part="PARTITION BY sensor_id ") + ")"))
def str14_keys(spark, sf):
    path = new_folder(spark, "monitor")
    rows = inputs.readings(_event_stream(spark, sf))
    jobs.run_available(rows, "str14-keys", each_batch=stateful.monitor_sink(path, key="sensor_id"))
    return told(stateful.read_messages(spark, path))


@query("jon06_frauds_stream", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + "SELECT * FROM frauds")
def jon06_stream(spark, sf):
    payments = inputs.transactions(_event_stream(spark, sf))
    return shown(_collected(joins.frauds(payments, _customers(spark, sf)), "jon06"))


@query("jon06_frauds_stream_salted", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + "SELECT * FROM frauds")
def jon06_salted(spark, sf):
    """The join's state holds the copies of all rows of two micro-batches, so these do not grow with the table."""
    payments = inputs.transactions(_event_stream(spark, sf, SALTED_ROWS))
    return shown(_collected(joins.frauds(payments, _customers(spark, sf), salts=4), "jon06-salted"))


def _halves(df: DataFrame, time) -> tuple[DataFrame, DataFrame]:
    early = time < F.lit("2024-01-15 00:00:00").cast("timestamp")
    return df.filter(early), df.filter(~early)


@query("str12_resume_from_checkpoint", with_(READINGS) + "SELECT sensor_id, reading_id, sensor_6 FROM readings")
def str12(spark, sf):
    source, out, checkpoint = (new_folder(spark, n) for n in ("resume-in", "resume-out", "resume-checkpoint"))
    rows = _readings(spark, sf).select("sensor_id", "reading_id", "sensor_6", "event_time")
    for part in _halves(rows, F.col("event_time")):
        part.drop("event_time").write.mode("append").parquet(source)
        stream = readers.read_folder(spark, source, part.drop("event_time").schema, stream=True)
        jobs.run_available(stream, "str12", path=out, checkpoint=checkpoint)
    return spark.read.parquet(out)


@query("str18_update_mode", with_(READINGS) + """
SELECT sensor_id, CAST(sum(sensor_0) AS BIGINT) AS total FROM readings GROUP BY sensor_id""")
def str18(spark, sf):
    path = new_folder(spark, "sums")
    sums = inputs.readings(_event_stream(spark, sf)).groupBy("sensor_id").agg(F.sum("sensor_0").alias("total"))
    jobs.run_available(sums, "str18", mode="update", each_batch=keyed.upsert(path, ["sensor_id"], ["total"]))
    return keyed.read_keyed(spark, path, ["sensor_id"])


@query("cdc06_resume_replica", with_(CHANGES, NEW) + "SELECT id, name FROM new_state")
def cdc06(spark, sf):
    source, replica, checkpoint = (new_folder(spark, n) for n in ("cdc-in", "cdc-replica", "cdc-checkpoint"))
    rows = _changes(spark, sf)
    for part in _halves(rows, F.timestamp_micros("ts")):
        part.write.mode("append").parquet(source)
        stream = readers.read_folder(spark, source, rows.schema, stream=True)
        jobs.run_available(stream, "cdc06", each_batch=pipelines.replica_sink(replica), checkpoint=checkpoint)
    return pipelines.read_replica(spark, replica)


@query("cdc02_replica_stream", with_(CHANGES, NEW) + "SELECT id, name FROM new_state")
def cdc02_stream(spark, sf):
    path = new_folder(spark, "replica")
    jobs.run_available(inputs.change_rows(_event_stream(spark, sf)), "cdc02", each_batch=pipelines.replica_sink(path))
    return pipelines.read_replica(spark, path)


@query("pip01_edge_messages_to_topic", with_(RECORDS) + f"""
SELECT key, {RECORD_TEXT} AS value, 'iot' AS topic FROM records WHERE sensor_0 < 500 AND sensor_1 < 500""")
def pip01(spark, sf):
    published, _ = pipelines.edge_to_topic(_records(spark, sf), "iot/#")
    return published.select(F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"), "topic")


def _enriched(spark: SparkSession, sf: str) -> tuple[str, str, str, str]:
    """Folders of all outputs of the enrichment job."""
    source = inputs.topic_records(_event_stream(spark, sf))
    table, out, avro, watch = (new_folder(spark, n) for n in ("sensors", "enriched", "enriched-avro", "watch"))
    jobs.run_available(source, "pip02", each_batch=pipelines.enriched_sink(
        table, out, avro, default_result=F.col("sensor_3") % 2, avro_format="parquet",
        monitor=pipelines.watch_readings(watch)))
    return table, out, avro, watch


@query("pip02_enriched_table", with_(RECORDS) + f"""
SELECT sensor_id, sensor_ts, {', '.join(f'CAST(sensor_{i} AS DOUBLE) AS sensor_{i}' for i in range(12))},
       coalesce(result, sensor_3 % 2) AS is_healthy FROM records""")
def pip02(spark, sf):
    table, _, _, _ = _enriched(spark, sf)
    return keyed.read_keyed(spark, table, schemas.TABLE_KEYS["sensors"])


ENRICHED = f"""
SELECT sensor_id, sensor_ts, coalesce(result, sensor_3 % 2) AS is_healthy, coalesce(result, sensor_3 % 2) AS result, {SENSOR_LIST}
FROM records"""


@query("pip02_enriched_topic", with_(RECORDS) + ENRICHED)
def pip02_topic(spark, sf):
    _, out, _, _ = _enriched(spark, sf)
    return rec.parse_json_flat(spark.read.parquet(out), schemas.READING_WIRE).select("*", "response.result").drop("response")


@query("pip02_enriched_files", with_(RECORDS) + ENRICHED)
def pip02_files(spark, sf):
    _, _, avro, _ = _enriched(spark, sf)
    return spark.read.parquet(avro).select("*", "response.result").drop("response", "batch_id")


@query("pip02_monitor", with_(READINGS) + MONITOR_SQL.format(
    gaps=f"SELECT 'all' AS monitor, * FROM ({GAP.format(keys='', part='')})"))
def pip02_monitor(spark, sf):
    return told(stateful.read_messages(spark, _enriched(spark, sf)[3]))


@query("pip03_statistics_view", with_(READINGS, f"stats AS ({sliding_sql('device_id', PLAUSIBLE, CLOSED)})", LATEST_STATS) + """
SELECT * FROM latest""")
def pip03(spark, sf):
    path = new_folder(spark, "sensor-view")
    rows = inputs.readings(_event_stream(spark, sf)).withWatermark("event_time", "3 seconds")
    jobs.run_available(pipelines.sensor_statistics(rows), "pip03", each_batch=pipelines.statistics_view(path))
    found = views.read_view(spark, path, ["device_id"], ["windowEnd"], ignore_nulls=True)
    return found.withColumn("windowEnd", epoch.naive("windowEnd"))


@query("pip04_scored_payments", with_(TRANSACTIONS) + """
SELECT transaction_id, account_id, fraud_score FROM transactions WHERE fraud_score > 0.90""")
def pip04(spark, sf):
    lines = _written(inputs.raw_transactions(inputs.load(spark, sf, "events")), "lines", "text")
    number = F.col("transaction_id").cast("bigint")
    scorer = lambda d: d.withColumn("model_response", F.struct(((number % 100) / F.lit(100.0)).alias("fraud_score")))
    scored = pipelines.score_payments(readers.read_lines(spark, lines, stream=True), scorer)
    payments, suspects, table = (new_folder(spark, n) for n in ("payments", "suspects", "payment-table"))
    jobs.run_available(scored, "pip04", each_batch=pipelines.payments_sink(payments, suspects, table))
    found = rec.parse_json_flat(spark.read.parquet(suspects), "transaction_id string, account_id string, fraud_score double")
    return found


@query("pip05_geographic_fraud", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + """
SELECT event_time, account_id AS acc_id, arg_max(txn2_id, CAST(txn2_id AS BIGINT)) AS transaction_id, max(f_name) AS f_name
FROM frauds GROUP BY 1, 2""")
def pip05(spark, sf):
    topic, table = new_folder(spark, "fraud-topic"), new_folder(spark, "fraud-table")
    found = joins.frauds(inputs.transactions(_event_stream(spark, sf)), _customers(spark, sf))
    jobs.run_available(found, "pip05", each_batch=pipelines.fraud_sink(topic, table))
    stored = keyed.read_keyed(spark, table, schemas.TABLE_KEYS["fraudulent_txn"])
    return stored.select(epoch.naive(F.col("event_time").cast("timestamp")).alias("event_time"), "acc_id", "transaction_id", "f_name")


MOVES = """moves AS (
  SELECT CAST(user_id AS BIGINT) AS id, CAST(user_id + 1000000 AS BIGINT) AS new_id, 'n' || max(event_id) AS name
  FROM events GROUP BY user_id)"""


@query("cdc02_update_of_the_key", with_(MOVES) + """
SELECT CASE WHEN id % 2 = 0 THEN new_id ELSE id END AS id, name FROM moves""")
def cdc02_moves(spark, sf):
    found = inputs.load(spark, sf, "events").groupBy(F.col("user_id").cast("bigint").alias("id")).agg(
        F.concat(F.lit("n"), F.max("event_id").cast("string")).alias("name"))
    row = lambda i, name: F.struct(i.cast("bigint").alias("id"), name.alias("name"))
    before = row(F.col("id"), F.lit("old"))
    after = row(F.when(F.col("id") % 2 == 0, F.col("id") + 1_000_000).otherwise(F.col("id")), F.col("name"))
    nothing = F.lit(None).cast("struct<id:bigint,name:string>")
    one = lambda op, b, a, n: found.select(F.lit(op).alias("op"), b.alias("before"), a.alias("after"),
                                           F.lit(n).cast("bigint").alias("ts"), F.lit(n).cast("bigint").alias("seq"))
    path = new_folder(spark, "moved")
    sink = pipelines.replica_sink(path)
    for n, batch in enumerate([one("c", nothing, before, 0), one("u", before, after, 1)]):
        sink(batch, n)
    keyed.compact(spark, path, ["id"], ["ts", "seq"], upto=1)
    return pipelines.read_replica(spark, path)


@query("snk10_array_quarantine", """
SELECT event_id % 10 = 0 AS bad, count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1""")
def snk10_array(spark, sf):
    number = F.col("event_id").cast("string")
    text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit('[{"id":'), number)).otherwise(
        F.concat(F.lit('[{"id":'), number, F.lit("}]")))
    messages = inputs.load(spark, sf, "events").select(text.alias("value"))
    good, bad = rec.parse_json_array(messages, "id bigint")
    found = good.select(F.lit(False).alias("bad"), F.col("data.id").alias("id")).unionByName(
        bad.select(F.lit(True).alias("bad"), F.regexp_extract("decoded", "[0-9]+", 0).cast("bigint").alias("id")))
    return found.groupBy("bad").agg(F.count("*").alias("messages"), F.sum("id").alias("total"))


@query("pip06_change_log_of_stream", with_(CHANGES) + """
SELECT ts, seq, 0 AS part, 'd' AS op, 'null' AS after FROM changes WHERE op IN ('d', 'u')
UNION ALL SELECT ts, seq, CASE op WHEN 'u' THEN 1 ELSE 0 END, 'c', '{"id":' || id || ',"name":"' || name || '"}'
FROM changes WHERE op IN ('c', 'u')""")
def pip06(spark, sf):
    replica, log = new_folder(spark, "replica"), new_folder(spark, "change-log")
    jobs.run_available(inputs.change_rows(_event_stream(spark, sf)), "pip06", each_batch=pipelines.replica_sink(replica, log))
    after = F.coalesce(F.to_json("after"), F.lit("null"))
    return spark.read.parquet(log).select("ts", "seq", "part", "op", after.alias("after"))


@query("pip08_dashboard", with_(READINGS) + """
SELECT 'likely_to_break' AS report, count(*) AS n FROM readings WHERE is_healthy = 0
UNION ALL SELECT 'health_counts', count(DISTINCT is_healthy) FROM readings
UNION ALL SELECT 'row_count', 1
UNION ALL SELECT 'newest', least(100, count(*)) FROM readings
UNION ALL SELECT 'averages', least(100, count(*)) FROM (SELECT DISTINCT sensor_ts, sensor_id FROM readings)
UNION ALL SELECT 'last_minute', count(DISTINCT sensor_id) FROM readings WHERE event_time > TIMESTAMP '2024-01-20' - INTERVAL 60 SECOND""")
def pip08(spark, sf):
    parts = pipelines.dashboard(_readings(spark, sf), F.lit("2024-01-20 00:00:00").cast("timestamp"))
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n") for name, df in parts.items()]
    result = counted[0]
    for c in counted[1:]:
        result = result.unionByName(c)
    return result
