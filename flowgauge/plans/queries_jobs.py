"""Queries for jobs that go on over restarts, failures, late rows and hot keys, and for whole outputs of the pipelines.

As in ``queries_tables`` each works in a fresh place in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import epoch
from ..operators import changes, joins, model, reports, timewindows
from ..session import new_folder
from ..sources import readers, records as rec, schemas
from ..streaming import hotkeys, jobs, keyed, late, sinks, views
from . import inputs, pipelines
from .queries_analytics import (CHANGES, CUSTOMERS, FRAUDS, NEW, ORDER, _changes, _customers, shown)
from .queries_tables import _collected, _event_stream, _halves, _written
from .queries_values import _readings, _transactions
from .registry import READINGS, TRANSACTIONS, query, with_

DAY = 86_400


# --- views whose storage shrinks --------------------------------------------

@query("str10_expired_view_stream", with_(READINGS) + f"""
SELECT sensor_id, arg_max(reading_id, (sensor_ts, reading_id)) AS reading_id, max(sensor_ts) AS sensor_ts,
       arg_max(sensor_0, (sensor_ts, reading_id)) AS sensor_0 FROM readings GROUP BY 1
HAVING max(sensor_ts) // {DAY}000000 >= ((SELECT max(sensor_ts) FROM readings) - {DAY}000000) // {DAY}000000""")
def str10_expired(spark, sf):
    """What is left in storage: slots of a day, dropped whole."""
    path = new_folder(spark, "view")
    rows = inputs.readings(_event_stream(spark, sf)).select("sensor_id", "reading_id", "sensor_ts", "sensor_0")
    newest = []

    def sink(batch: DataFrame, n: int) -> None:
        views.view_sink(path, ["sensor_id"], ORDER, retention=DAY)(batch, n)
        newest.append(batch.agg(F.max("sensor_ts")).first()[0])
        views.expire(spark, path, ["sensor_id"], ORDER, newest[-1], retention=DAY)

    jobs.run_available(rows, "str10-expired", each_batch=sink)
    return views.read_view(spark, path, ["sensor_id"], ORDER)


@query("str10_expired_ignore_nulls_stream", with_(READINGS) + f"""
SELECT sensor_id, max(reading_id) AS reading_id, max(sensor_ts) AS sensor_ts,
       arg_max(sensor_0, (sensor_ts, reading_id)) FILTER (reading_id % 3 = 0) AS sensor_0 FROM (
  SELECT sensor_id, reading_id, sensor_ts, sensor_0, max(sensor_ts) OVER (PARTITION BY sensor_id) AS newest FROM readings)
WHERE newest >= (SELECT max(sensor_ts) FROM readings) - {DAY}000000 GROUP BY 1""")
def str10_expired_nulls(spark, sf):
    path = new_folder(spark, "view")
    rows = inputs.readings(_event_stream(spark, sf)).select(
        "sensor_id", F.col("reading_id").alias("reading_id"), "sensor_ts",
        F.when(F.col("reading_id") % 3 == 0, F.col("sensor_0")).alias("sensor_0"))
    newest = []

    def sink(batch: DataFrame, n: int) -> None:
        views.view_sink(path, ["sensor_id"], ORDER, ignore_nulls=True, retention=DAY)(batch, n)
        newest.append(batch.agg(F.max("sensor_ts")).first()[0])

    jobs.run_available(rows, "str10-expired-nulls", each_batch=sink)
    for _ in range(2):
        views.expire(spark, path, ["sensor_id"], ORDER, newest[-1], ignore_nulls=True, retention=DAY)
    found = views.read_view(spark, path, ["sensor_id"], ORDER, ignore_nulls=True)
    return found.filter(F.col("sensor_ts") >= newest[-1] - DAY * 1_000_000)


# --- hot accounts on a stream -----------------------------------------------

HOT_ROWS = 500_000  # of a micro-batch at most: a payment of the hot account is kept once for each of its salts
HOT_PAYMENTS = TRANSACTIONS.replace(
    "CAST(user_id AS VARCHAR) AS account_id", "CASE WHEN event_id % 5 < 3 THEN '1' ELSE CAST(user_id AS VARCHAR) END AS account_id")


@query("jon06_frauds_stream_hot_account", with_(HOT_PAYMENTS, CUSTOMERS, FRAUDS) + "SELECT * FROM frauds")
def jon06_hot(spark, sf):
    """Three in five payments are of one account: found by the sketch of the first run, salted in the second.

    The pairs of that account grow with the square of its payments in an interval, and are all written.
    """
    source, out, checkpoint, sketch = (new_folder(spark, n) for n in ("hot-in", "hot-out", "hot-checkpoint", "hot-sketch"))
    rows = _transactions(spark, sf)
    account = F.when(F.col("transaction_id").cast("bigint") % 5 < 3, F.lit("1")).otherwise(F.col("account_id"))
    rows = rows.withColumn("account_id", account)
    plan, found = hotkeys.NO_SALTS, None
    for n, part in enumerate(_halves(rows, F.col("event_time"))):
        files = inputs.add_in_time_order(part, "event_time", source, most=HOT_ROWS)
        stream = readers.read_folder(spark, source, rows.schema, stream=True, max_files=files)
        found = joins.frauds(stream, _customers(spark, sf), salts=plan)
        jobs.run_available(found, "jon06-hot", path=out, checkpoint=checkpoint, compression="zstd")
        hotkeys.sketch_sink(sketch, ["account_id"])(part, n)
        plan = hotkeys.next_salts(spark, sketch, tasks=8, earlier=plan)
    return shown(spark.read.schema(found.schema).parquet(out))


# --- snapshots under way, failed writes, late rows ----------------------------

CHUNKS = 4
# Marks of the log around each chunk, and where in between the chunk is read: fifths and tenths of the log.
MARKS = f"""last_seq AS (SELECT max(seq) AS m FROM changes),
marks AS (SELECT k, m * (2 * k + 1) // {2 * CHUNKS + 2} AS low, m * (4 * k + 3) // {4 * CHUNKS + 4} AS read_at,
                 m * (2 * k + 2) // {2 * CHUNKS + 2} AS high FROM last_seq, range({CHUNKS}) r(k))"""


def _chunks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Chunks of ids, each read at another place of the change log; and the log from the first mark on."""
    log = _changes(spark, sf)
    m = log.agg(F.max("seq")).first()[0] or 0
    whole = None
    for k in range(CHUNKS):
        low, at, high = m * (2 * k + 1) // (2 * CHUNKS + 2), m * (4 * k + 3) // (4 * CHUNKS + 4), m * (2 * k + 2) // (2 * CHUNKS + 2)
        seen = log.filter(F.col("seq") <= at)
        state = changes.apply_changes(seen, ["id"], ["seq"]).filter(F.pmod("id", F.lit(CHUNKS)) == k)
        chunk = state.withColumns({"low": F.lit(low).cast("bigint"), "high": F.lit(high).cast("bigint")})
        whole = chunk if whole is None else whole.unionByName(chunk)
    return whole, log.filter(F.col("seq") > m // (2 * CHUNKS + 2))


@query("cdc01_snapshot_while_changing", with_(CHANGES, MARKS) + f"""
, reads AS (SELECT k, low, high, id, arg_max(op, seq) AS op, arg_max(name, seq) AS name
  FROM marks JOIN changes ON id % {CHUNKS} = k AND seq <= read_at GROUP BY ALL)
SELECT 'r' AS op, id, name, low AS seq, 1 AS part FROM reads
WHERE op <> 'd' AND NOT EXISTS (SELECT 1 FROM changes c WHERE c.id = reads.id AND c.seq > low AND c.seq <= high)
UNION ALL SELECT op, id, name, seq, 0 FROM changes WHERE seq > (SELECT min(low) FROM marks)""")
def cdc01_interleaved(spark, sf):
    chunks, log = _chunks(spark, sf)
    image = F.coalesce("after", "before")
    return changes.interleaved_snapshot(chunks, log, ["id"]).select(
        "op", image["id"].alias("id"), image["name"].alias("name"), "seq", "part")


@query("set01_snapshot_while_changing", with_(CHANGES, NEW) + "SELECT id, name FROM new_state")
def set01_interleaved(spark, sf):
    """The replica that the interleaved log gives is the final state, though no chunk was read at the end."""
    chunks, log = _chunks(spark, sf)
    events = changes.interleaved_snapshot(chunks, log, ["id"])
    return changes.apply_changes(events, ["id"], ["seq", "part"])


@query("snk10_retry_stream", with_(TRANSACTIONS) + """
SELECT 'table' AS place, transaction_id, account_id AS acc_id, ts, amount FROM transactions""")
def snk10_retry(spark, sf):
    """The write of the second micro-batch fails twice, that of the third once; all rows arrive, once."""
    table, retry = new_folder(spark, "payment-table"), new_folder(spark, "retry")
    failures = {1: 2, 2: 1}
    store = keyed.upsert(table, schemas.TABLE_KEYS["transactions"], by=pipelines.by_number("transaction_id"))

    def sink(batch: DataFrame, n: int) -> None:
        if failures.get(n, 0):
            failures[n] -= 1
            raise OSError("the table does not answer")
        store(batch.select("ts", F.col("account_id").alias("acc_id"), "transaction_id", "amount"), n)

    kept = sinks.retrying(sink, retry, attempts=4, wait_s=lambda attempt: 0.0)
    rows = inputs.transactions(inputs.feed(spark, sf, "events", "ts", new_folder(spark, "feed"), 5))
    jobs.run_available(rows, "snk10-retry", each_batch=kept)
    columns = ["transaction_id", "acc_id", "ts", "amount"]
    found = keyed.read_keyed(spark, table, schemas.TABLE_KEYS["transactions"]).select(F.lit("table").alias("place"), *columns)
    dead = sinks.dead_letters(spark, retry)
    if dead is None:
        return found
    return found.unionByName(dead.withColumnRenamed("account_id", "acc_id").select(F.lit("dead").alias("place"), *columns))


LATE = """batches AS (SELECT *, reading_id % 4 AS n FROM readings),
newest AS (SELECT b AS n, (SELECT max(epoch_us(event_time) // 1000) FROM batches WHERE n < b - 1) AS ms FROM range(4) r(b)),
judged AS (SELECT batches.*, coalesce((sensor_ts // 3600000000 + 1) * 3600000 <= ms - 3000, false) AS late FROM batches JOIN newest USING (n))"""


def _dealt(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream in four micro-batches, each of which runs over the whole time."""
    rows = inputs.load(spark, sf, "events")
    folder = new_folder(spark, "feed")
    for n in range(4):
        rows.filter(F.col("event_id") % 4 == n).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("str15_late_rows_stream", with_(READINGS, LATE) + "SELECT reading_id, sensor_0, late FROM judged")
def str15(spark, sf):
    path = new_folder(spark, "late")
    jobs.run_available(inputs.readings(_dealt(spark, sf)), "str15", each_batch=late.late_sink(
        path, sinks.file_batch(f"{path}/on-time"), sinks.file_batch(f"{path}/late"), "1 hour"))
    part = lambda name, flag: spark.read.parquet(f"{path}/{name}").select("reading_id", "sensor_0", F.lit(flag).alias("late"))
    return part("on-time", False).unionByName(part("late", True))


@query("str15_windows_without_late_rows_stream", with_(READINGS, LATE) + """
SELECT sensor_id, make_timestamp((sensor_ts // 3600000000 + 1) * 3600000000) AS "windowEnd", CAST(sum(sensor_0) AS BIGINT) AS total
FROM judged WHERE NOT late GROUP BY 1, 2
HAVING epoch_us("windowEnd") // 1000 <= (SELECT max(epoch_us(event_time) // 1000) FROM readings) - 3000""")
def str15_windows(spark, sf):
    """The aggregate's own windows hold the rows that the side output calls on time, and no others."""
    rows = inputs.readings(_dealt(spark, sf)).withWatermark("event_time", "3 seconds")
    found = _collected(timewindows.tumbling_sum(rows, size="1 hour"), "str15-windows")
    return found.withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str16_state_after_cleanup_stream", with_(TRANSACTIONS) + """
, mark AS (SELECT max(ts) - 603000 AS ms FROM transactions)
SELECT 'first' AS side, transaction_id FROM transactions, mark WHERE ts + 600000 >= ms
UNION ALL SELECT 'second', transaction_id FROM transactions, mark WHERE ts >= ms""")
def str16(spark, sf):
    """Payments that the fraud join still holds at the end: those that a later one may still meet."""
    checkpoint, out = new_folder(spark, "state-checkpoint"), new_folder(spark, "state-out")
    found = joins.frauds(inputs.transactions(_event_stream(spark, sf)), _customers(spark, sf))
    jobs.run_available(found, "str16", path=out, checkpoint=checkpoint)
    held = lambda side, name, column: jobs.state_rows(spark, checkpoint, side).select(
        F.lit(name).alias("side"), F.col(f"value.{column}").alias("transaction_id"))
    return held("left", "first", "a_transaction_id").unionByName(held("right", "second", "b_transaction_id"))


@query("str13_job_history", """
SELECT 'counted' AS job, CAST(1 AS BIGINT) AS runs, 'stopped' AS state, CAST(4 AS BIGINT) AS batches, count(*) AS rows, false AS error FROM events
UNION ALL SELECT 'broken', 1, 'failed', 0, NULL, true""")
def str13(spark, sf):
    path = new_folder(spark, "history")
    listener = jobs.JobHistory(spark, path)
    spark.streams.addListener(listener)

    def broken(batch: DataFrame, n: int) -> None:
        raise ValueError("this job fails")

    try:
        jobs.run_available(_event_stream(spark, sf), "counted", each_batch=sinks.file_batch(f"{path}-rows"))
        try:
            jobs.run_available(_event_stream(spark, sf), "broken", each_batch=broken)
        except Exception as error:
            if "this job fails" not in str(error):
                raise
        listener.wait_for(["counted", "broken"])
    finally:
        spark.streams.removeListener(listener)
    states = jobs.job_states(jobs.history(spark, path))
    return states.withColumn("error", F.col("error").isNotNull())


@query("rte03_empty_outputs_stream", with_(TRANSACTIONS) + """
SELECT 'flattened' AS route, CAST(4 AS BIGINT) AS batches, count(*) AS rows FROM transactions
UNION ALL SELECT 'likely_fraud', 1, count(*) FROM transactions WHERE transaction_id = '7' HAVING count(*) > 0""")
def rte03(spark, sf):
    """A route that has rows in one micro-batch is written once, others each time."""
    path = new_folder(spark, "routes")
    outputs = {"flattened": lambda d: d, "likely_fraud": lambda d: d.filter("transaction_id = '7'"), "never": lambda d: d.filter("amount < 0")}
    sink = sinks.routed(outputs, {name: sinks.file_batch(f"{path}/route={name}") for name in outputs})
    jobs.run_available(inputs.transactions(_event_stream(spark, sf)), "rte03", each_batch=sink)
    return spark.read.parquet(path).groupBy("route").agg(
        F.countDistinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("rows"))


@query("snk08_console_stream", "SELECT 'console' AS job, CAST(4 AS BIGINT) AS batches, count(*) AS rows, 'stopped' AS state FROM events")
def snk08(spark, sf):
    """What a console job was given, from its history."""
    path = new_folder(spark, "console-history")
    listener = jobs.JobHistory(spark, path)
    spark.streams.addListener(listener)
    try:
        jobs.run_available(_event_stream(spark, sf), "console", fmt="console", numRows=1)
        listener.wait_for(["console"])
    finally:
        spark.streams.removeListener(listener)
    return jobs.job_states(jobs.history(spark, path)).select("job", "batches", "rows", "state")


# --- model figures that can be repeated ---------------------------------------

SPLIT = """placed AS (SELECT *, CAST('0x' || substr(md5('7|' || reading_id), 1, 8) AS BIGINT) < 3006477107 AS train FROM readings)"""


@query("ml02_split_by_key", with_(READINGS, SPLIT) + """
SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, reading_id FROM placed""")
def ml02_by_key(spark, sf):
    parts = model.split_by_key(_readings(spark, sf), ["reading_id"], 0.7, 7)
    return parts[0].select(F.lit("train").alias("part"), "reading_id").unionByName(
        parts[1].select(F.lit("test").alias("part"), "reading_id"))


# A score that stands in the table: two of the readings that the label looks at, with many ties.
SCORED = """scored AS (
  SELECT CASE WHEN sensor_1 > 40 AND sensor_3 > 30 THEN 0 ELSE 1 END AS label, 100 - sensor_1 - sensor_3 // 2 AS score FROM readings)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when((F.col("sensor_1") > 40) & (F.col("sensor_3") > 30), 0).otherwise(1)
    half = F.call_function("div", F.col("sensor_3"), F.lit(2))
    return _readings(spark, sf).select(label.alias("label"), (100 - F.col("sensor_1") - half).cast("double").alias("score"))


@query("ml04_exact_metrics", with_(READINGS, SCORED) + """
, folded AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY 1),
sums AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
  FROM folded WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(n * (2 * tp - p)) / (2.0 * max(all_p) * max(all_n)), 9) AS auroc,
       round(sum(p * (tp / (tp + fp))) / max(all_p), 9) AS ap FROM sums""")
def ml04_exact(spark, sf):
    found = model.ranked_metrics(_scored(spark, sf), "label", "score")
    return found.select(F.round("auroc", 9).alias("auroc"), F.round("ap", 9).alias("ap"))


@query("ml05_confusion_of_scores", with_(READINGS, SCORED) + """
SELECT label, count(*) FILTER (score < 40) AS predicted_0, count(*) FILTER (score >= 40) AS predicted_1 FROM scored GROUP BY 1""")
def ml05_scores(spark, sf):
    return reports.confusion(_scored(spark, sf).withColumn("prediction", (F.col("score") >= 40).cast("int")))


# --- whole outputs of the pipelines -------------------------------------------

def _paid(spark: SparkSession, sf: str) -> tuple[str, str, str, str]:
    """Folders of the scored-payments job over the payment lines, of which each eleventh is cut short."""
    events = inputs.load(spark, sf, "events")
    lines = inputs.raw_transactions(events)
    number = F.regexp_extract("value", '"transaction_id":"([0-9]+)"', 1).cast("bigint")
    damaged = F.when(number % 11 == 0, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    path = _written(lines.select(damaged.alias("value")), "lines", "text")
    score = (F.col("transaction_id").cast("bigint") % 100) / F.lit(100.0)
    scorer = lambda d: d.withColumn("model_response", F.struct(score.alias("fraud_score")))
    payments, suspects, table, retry = (new_folder(spark, n) for n in ("payments", "suspects", "payment-table", "retry"))
    write = pipelines.payments_sink(payments, suspects, table, retry_path=retry)
    rejected = sinks.file_batch(f"{retry}/rejected", shape=pipelines.rejected_payments)
    both = sinks.fan_out(lambda d, n: write(pipelines.score_payments(d, scorer), n), rejected)
    jobs.run_available(readers.read_lines(spark, path, stream=True), "pip04-whole", each_batch=both)
    return payments, suspects, table, retry


PAID = "SELECT {columns} FROM transactions WHERE CAST(transaction_id AS BIGINT) % 11 <> 0"
PAYMENT = "transaction_id string, account_id string, amount int, lat double, lon double, fraud_score double"
PAYMENT_COLUMNS = ", ".join(c.split()[0] for c in PAYMENT.split(", "))


@query("pip04_payments_topic", with_(TRANSACTIONS) + PAID.format(columns=PAYMENT_COLUMNS))
def pip04_topic(spark, sf):
    return rec.parse_json_flat(spark.read.parquet(_paid(spark, sf)[0]), PAYMENT)


@query("pip04_payments_table", with_(TRANSACTIONS) + PAID.format(
    columns="transaction_id, account_id AS acc_id, CAST(amount AS BIGINT) AS amount, lat, lon, fraud_score"))
def pip04_table(spark, sf):
    return keyed.read_keyed(spark, _paid(spark, sf)[2], schemas.TABLE_KEYS["transactions"]).drop("ts")


@query("pip04_rejected_lines", with_(TRANSACTIONS) + """
SELECT transaction_id FROM transactions WHERE CAST(transaction_id AS BIGINT) % 11 = 0""")
def pip04_rejected(spark, sf):
    rows = spark.read.parquet(f"{_paid(spark, sf)[3]}/rejected")
    return rows.select(F.regexp_extract("decoded", '"transaction_id":"([0-9]+)"', 1).alias("transaction_id"))


@query("pip02_enhanced_table", with_(READINGS) + f"""
SELECT sensor_id, sensor_ts, {', '.join(f'CAST(sensor_{i} AS DOUBLE) AS sensor_{i}' for i in range(12))}, is_healthy,
       CASE WHEN reading_id % 3 <> 0 THEN 'city-' || (sensor_id % 7) END AS city,
       CAST(sensor_id % 90 AS DOUBLE) AS lat, CAST(sensor_id % 180 AS DOUBLE) / 2 AS lon FROM readings""")
def pip02_enhanced(spark, sf):
    """Readings with a place; every third comes from an older client and names no city."""
    place = [F.when(F.col("reading_id") % 3 != 0, F.concat(F.lit("city-"), (F.col("sensor_id") % 7).cast("string"))).alias("city"),
             (F.col("sensor_id") % 90).cast("double").alias("lat"), ((F.col("sensor_id") % 180).cast("double") / 2).alias("lon")]
    rows = inputs.readings(_event_stream(spark, sf))
    wire = rows.select(F.to_json(F.struct(
        "sensor_id", "sensor_ts", F.struct(F.col("is_healthy").alias("result")).alias("response"),
        *schemas.SENSOR_COLUMNS, *place)).cast("binary").alias("value"))
    table, out, avro = (new_folder(spark, n) for n in ("sensors-enhanced", "enhanced", "enhanced-avro"))
    jobs.run_available(wire, "pip02-enhanced", each_batch=pipelines.enriched_sink(
        table, out, avro, avro_format="parquet", wire=schemas.READING_ENHANCED, stored=schemas.READING_ENHANCED_TABLE))
    return keyed.read_keyed(spark, table, schemas.TABLE_KEYS["sensors"])


def _fraud_outputs(spark: SparkSession, sf: str) -> tuple[str, str]:
    topic, table = new_folder(spark, "fraud-topic"), new_folder(spark, "fraud-table")
    found = joins.frauds(inputs.transactions(_event_stream(spark, sf)), _customers(spark, sf))
    jobs.run_available(found, "pip05-whole", each_batch=pipelines.fraud_sink(topic, table))
    return topic, table


@query("pip05_fraud_table", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + """
, numbered AS (SELECT *, row_number() OVER (PARTITION BY event_time, account_id
               ORDER BY length(txn2_id) DESC, txn2_id DESC) AS n FROM frauds)
SELECT event_time, account_id AS acc_id, txn2_id AS transaction_id, f_name, l_name, email, gender, phone, card, lat, lon,
       CAST(amount AS BIGINT) AS amount FROM numbered WHERE n = 1""")
def pip05_table(spark, sf):
    stored = keyed.read_keyed(spark, _fraud_outputs(spark, sf)[1], schemas.TABLE_KEYS["fraudulent_txn"])
    return stored.withColumn("event_time", epoch.naive(F.col("event_time").cast("timestamp")))


@query("pip05_fraud_topic", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + """
SELECT event_time, diff_ms, account_id, txn1_id, txn2_id, amount, lat, lon, lat1, lon1, distance, f_name, l_name, email, card, gender, phone
FROM frauds""")
def pip05_topic(spark, sf):
    fields = ", ".join(
        f"{c} {t}" for c, t in joins.frauds(_transactions(spark, sf).limit(0), _customers(spark, sf)).dtypes)
    return shown(rec.parse_json_flat(spark.read.parquet(_fraud_outputs(spark, sf)[0]), fields))


@query("pip06_replica_of_stream", with_(CHANGES, NEW) + "SELECT id, name FROM new_state")
def pip06_replica(spark, sf):
    replica, log = new_folder(spark, "replica"), new_folder(spark, "change-log")
    jobs.run_available(inputs.change_rows(_event_stream(spark, sf)), "pip06-replica", each_batch=pipelines.replica_sink(replica, log))
    return pipelines.read_replica(spark, replica)


def _report(name: str):
    return lambda spark, sf: pipelines.dashboard(_readings(spark, sf), F.lit("2024-01-20 00:00:00").cast("timestamp"))[name]


query("pip08_likely_to_break", with_(READINGS) + """
SELECT sensor_id, sensor_ts FROM readings WHERE is_healthy = 0""")(_report("likely_to_break"))
query("pip08_row_count", with_(READINGS) + "SELECT count(*) AS row_count FROM readings")(_report("row_count"))
query("pip08_health_counts", with_(READINGS) + """
SELECT is_healthy, count(*) AS occurrences FROM readings GROUP BY 1""")(_report("health_counts"))
query("pip08_newest", with_(READINGS) + """
SELECT sensor_id, sensor_ts, reading_id FROM readings ORDER BY sensor_ts DESC, sensor_id DESC LIMIT 100""")(
    lambda spark, sf: _report("newest")(spark, sf).select("sensor_id", "sensor_ts", "reading_id"))
query("pip08_averages", with_(READINGS) + """
SELECT make_timestamp(sensor_ts) AS sensor_timestamp, sensor_id, avg(sensor_0) AS avg_sensor_0, avg(sensor_1) AS avg_sensor_1
FROM readings GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 100""")(
    lambda spark, sf: _report("averages")(spark, sf).withColumn("sensor_timestamp", epoch.naive("sensor_timestamp")))
query("pip08_last_minute", with_(READINGS) + """
SELECT sensor_id, avg(sensor_0) AS avg_sensor_0 FROM readings
WHERE event_time > TIMESTAMP '2024-01-20' - INTERVAL 60 SECOND GROUP BY 1""")(_report("last_minute"))
