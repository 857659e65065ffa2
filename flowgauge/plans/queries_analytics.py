"""Queries for joins, aggregates, ordered rows, windows, change capture, topics and the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import epoch, text
from ..operators import changes, joins, model, ordered, quality, reports, timewindows, topics, views
from ..streaming import sinks
from . import inputs, pipelines
from .registry import (CHANGES, CUSTOMERS, READINGS, RECORD_TEXT, RECORDS, TRANSACTIONS, km_sql, query, with_)
from .queries_values import AS_OF, _readings, _records, _transactions

ORDER = ["sensor_ts", "reading_id"]


def _customers(spark, sf):
    return inputs.customers(inputs.load(spark, sf, "customer"))


def _changes(spark, sf):
    return inputs.change_rows(inputs.load(spark, sf, "events"))


# --- sliding and tumbling windows -----------------------------------------

def sliding_sql(key: str | None, where: str = "", having: str = "", size: int = 30, rows: str = "readings") -> str:
    k = f"sensor_id AS {key}, " if key else ""
    g = "sensor_id, " if key else ""
    return f"""
SELECT {k}w + INTERVAL {size} SECOND AS "windowEnd", count(*) AS "sensorCount", CAST(sum(sensor_6) AS BIGINT) AS "sensorSum",
       avg(CAST(sensor_6 AS DOUBLE)) AS "sensorAverage", min(sensor_6) AS "sensorMin", max(sensor_6) AS "sensorMax",
       CAST(sum(CASE WHEN sensor_6 > 70 THEN 1 ELSE 0 END) AS BIGINT) AS "sensorGreaterThan60"
FROM (SELECT *, unnest(generate_series(date_trunc('second', event_time) - INTERVAL {size - 1} SECOND,
                                       date_trunc('second', event_time), INTERVAL 1 SECOND)) AS w FROM {rows} {where})
GROUP BY {g}w {having}"""


PLAUSIBLE = "WHERE NOT (sensor_0 >= 500 OR sensor_1 >= 500)"


@query("str03_sliding_statistics", with_(READINGS) + sliding_sql("device_id", PLAUSIBLE))
def str03(spark, sf):
    return pipelines.sensor_statistics(_readings(spark, sf)).withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str04_sliding_statistics_overall", with_(READINGS) + sliding_sql(None))
def str04(spark, sf):
    return timewindows.sliding_stats(_readings(spark, sf), []).withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str05_window_end", with_(READINGS) + """
SELECT reading_id, date_trunc('second', event_time) - INTERVAL (CAST(second(event_time) AS INTEGER) % 10) SECOND
       + INTERVAL 10 SECOND AS "windowEnd" FROM readings""")
def str05(spark, sf):
    return _readings(spark, sf).select(
        "reading_id", epoch.naive(F.window("event_time", "10 seconds")["end"]).alias("windowEnd"))


@query("str06_tumbling_sum", with_(READINGS) + """
SELECT sensor_id, time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND AS "windowEnd",
       CAST(sum(sensor_0) AS BIGINT) AS total FROM readings GROUP BY ALL""")
def str06(spark, sf):
    return timewindows.tumbling_sum(_readings(spark, sf)).withColumn("windowEnd", epoch.naive("windowEnd"))


# --- joins ----------------------------------------------------------------

PAIRS = """
FROM transactions a JOIN transactions b ON a.account_id = b.account_id
 AND b.event_time BETWEEN a.event_time AND a.event_time + INTERVAL 10 MINUTE"""


@query("jon01_self_join_within_interval", with_(TRANSACTIONS) + f"""
SELECT a.account_id, a.transaction_id AS txn1_id, b.transaction_id AS txn2_id {PAIRS}""")
def jon01(spark, sf):
    t = _transactions(spark, sf)
    return joins.interval_join(t, t, ["account_id"]).select(
        F.col("a_account_id").alias("account_id"), F.col("a_transaction_id").alias("txn1_id"),
        F.col("b_transaction_id").alias("txn2_id"))


@query("jon02_interval_join", with_(READINGS, TRANSACTIONS) + """
SELECT r.reading_id, t.transaction_id, t.ts - r.sensor_ts // 1000 AS diff_ms
FROM (SELECT *, CAST(sensor_id AS VARCHAR) AS account_id FROM readings) r JOIN transactions t ON t.account_id = r.account_id
 AND t.event_time BETWEEN r.event_time AND r.event_time + INTERVAL 2 HOUR
WHERE CAST(r.reading_id AS VARCHAR) <> t.transaction_id""")
def jon02(spark, sf):
    left = _readings(spark, sf).withColumn("account_id", F.col("sensor_id").cast("string"))
    other = F.col("a_reading_id").cast("string") != F.col("b_transaction_id")
    pairs = joins.interval_join(left, _transactions(spark, sf), ["account_id"], interval="2 hours", residual=other)
    return pairs.select(
        F.col("a_reading_id").alias("reading_id"), F.col("b_transaction_id").alias("transaction_id"),
        (F.col("b_ts") - epoch.truncating_div("a_sensor_ts", 1000)).alias("diff_ms"))


@query("jon03_theta_residual", with_(TRANSACTIONS) + f"""
SELECT a.transaction_id AS txn1_id, b.transaction_id AS txn2_id, b.ts - a.ts AS diff_ms {PAIRS}
 AND a.transaction_id <> b.transaction_id AND {km_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} > 100""")
def jon03(spark, sf):
    from ..functions.geo import haversine_km

    t = _transactions(spark, sf)
    far = haversine_km("a_lat", "a_lon", "b_lat", "b_lon") > 100
    pairs = joins.interval_join(t, t, ["account_id"], residual=far & (F.col("a_transaction_id") != F.col("b_transaction_id")))
    return pairs.select(F.col("a_transaction_id").alias("txn1_id"), F.col("b_transaction_id").alias("txn2_id"),
                        epoch.elapsed_ms("b_ts", "a_ts").alias("diff_ms"))


@query("jon04_dimension_join", with_(TRANSACTIONS, CUSTOMERS) + """
SELECT t.transaction_id, t.amount, c.* FROM transactions t JOIN customers c ON c.acc_id = t.account_id""")
def jon04(spark, sf):
    c = _customers(spark, sf)
    joined = joins.with_dimension(_transactions(spark, sf), c, F.col("acc_id") == F.col("account_id"))
    return joined.select("transaction_id", "amount", *c.columns)


@query("jon05_lookup_keeps_rows", with_(READINGS) + """
SELECT r.reading_id, p.p_size AS size, p.p_brand AS brand FROM readings r LEFT JOIN part p ON p.p_partkey = r.reading_id""")
def jon05(spark, sf):
    table = inputs.load(spark, sf, "part").select(F.col("p_partkey").alias("reading_id"), "p_size", "p_brand")
    rows = joins.lookup(_readings(spark, sf).select("reading_id"), table, ["reading_id"])
    return rows.select("reading_id", F.col("response.p_size").alias("size"), F.col("response.p_brand").alias("brand"))


FRAUDS = f"""frauds AS (
SELECT a.event_time AS event_time, b.ts - a.ts AS diff_ms, a.account_id, a.transaction_id AS txn1_id,
       b.transaction_id AS txn2_id, b.amount, b.lat, b.lon, a.lat AS lat1, a.lon AS lon1,
       round({km_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS distance,
       c.f_name, c.l_name, c.email, c.card, c.gender, c.phone {PAIRS}
 JOIN customers c ON c.acc_id = a.account_id
WHERE a.transaction_id <> b.transaction_id AND {km_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} > 1)"""


def shown(found):
    """Fraud rows with a comparable time and a rounded distance."""
    return found.withColumns({
        "event_time": epoch.naive(F.col("event_time").cast("timestamp")), "distance": F.round("distance", 6)})


@query("jon06_frauds", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + "SELECT * FROM frauds")
def jon06(spark, sf):
    return shown(joins.frauds(_transactions(spark, sf), _customers(spark, sf)))


# --- aggregates and reports -----------------------------------------------

@query("agg01_row_count", "SELECT count(*) AS row_count FROM events")
def agg01(spark, sf):
    return reports.row_count(_readings(spark, sf))


@query("agg02_count_per_group", with_(READINGS) + """
SELECT is_healthy, count(*) AS occurrences FROM readings GROUP BY is_healthy""")
def agg02(spark, sf):
    return reports.count_by(_readings(spark, sf), ["is_healthy"])


@query("agg03_sum_count_min_max", with_(READINGS) + """
SELECT sensor_id, count(*) AS n, CAST(sum(sensor_6) AS BIGINT) AS total, min(sensor_6) AS low, max(sensor_6) AS high
FROM readings GROUP BY sensor_id""")
def agg03(spark, sf):
    return _readings(spark, sf).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sensor_6").alias("total"), F.min("sensor_6").alias("low"),
        F.max("sensor_6").alias("high"))


@query("agg04_average_of_cast", with_(READINGS) + """
SELECT sensor_id, avg(CAST(sensor_6 AS DOUBLE)) AS average FROM readings GROUP BY sensor_id""")
def agg04(spark, sf):
    return _readings(spark, sf).groupBy("sensor_id").agg(F.avg(F.col("sensor_6").cast("float")).alias("average"))


@query("agg05_conditional_count", with_(READINGS) + """
SELECT sensor_id, CAST(sum(CASE WHEN sensor_6 > 70 THEN 1 ELSE 0 END) AS BIGINT) AS over FROM readings GROUP BY sensor_id""")
def agg05(spark, sf):
    return _readings(spark, sf).groupBy("sensor_id").agg(F.count_if(F.col("sensor_6") > 70).alias("over"))


@query("agg06_average_by_time_and_id", with_(READINGS) + """
SELECT event_time AS sensor_timestamp, sensor_id, avg(sensor_0) AS avg_sensor_0, avg(sensor_1) AS avg_sensor_1
FROM readings GROUP BY 1, 2""")
def agg06(spark, sf):
    rows = _readings(spark, sf).withColumn("sensor_timestamp", epoch.naive(epoch.timestamp_from_us("sensor_ts")))
    return reports.average_by(rows, ["sensor_timestamp", "sensor_id"], ["sensor_0", "sensor_1"])


@query("agg07_average_last_minute", with_(READINGS) + f"""
SELECT sensor_id, avg(sensor_0) AS avg_sensor_0, round(CASE WHEN avg(sensor_0) > 0 THEN log10(avg(sensor_0)) END, 9) AS log_sensor_0
FROM readings WHERE event_time > TIMESTAMP '{AS_OF}' - INTERVAL 60 SECOND GROUP BY sensor_id""")
def agg07(spark, sf):
    found = reports.average_last_minute(_readings(spark, sf), F.lit(AS_OF).cast("timestamp"), log_axis=True)
    return found.withColumn("log_sensor_0", F.round("log_sensor_0", 9))


@query("agg08_confusion_table", with_(READINGS) + """
SELECT is_healthy AS label, CAST(sum(CASE WHEN sensor_6 > 70 THEN 0 ELSE 1 END) AS BIGINT) AS predicted_1,
       CAST(sum(CASE WHEN sensor_6 > 70 THEN 1 ELSE 0 END) AS BIGINT) AS predicted_0 FROM readings GROUP BY 1""")
def agg08(spark, sf):
    rows = _readings(spark, sf).select(F.col("is_healthy").alias("label"),
                                       F.when(F.col("sensor_6") > 70, 0).otherwise(1).alias("prediction"))
    return reports.confusion(rows)


@query("agg09_topic_totals", with_(RECORDS, f"""parts AS (
  SELECT topic, "partition", count(*) AS messages, CAST(sum(strlen({RECORD_TEXT})) AS BIGINT) AS bytes FROM records GROUP BY 1, 2)""") + """
SELECT topic, "partition", CAST(sum(messages) AS BIGINT) AS messages, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS partitions
FROM parts GROUP BY ROLLUP (topic, "partition")""")
def agg09(spark, sf):
    return topics.topic_totals(_records(spark, sf))


@query("agg10_producer_totals", with_(RECORDS) + """
SELECT client_id, topic, count(*) AS messages FROM records GROUP BY 1, 2""")
def agg10(spark, sf):
    from ..sources.records import header_value

    return topics.producer_totals(_records(spark, sf), header_value(r"client\.id"))


COMMITTED = """committed AS (
  SELECT g AS group_id, topic, "partition", max("offset") + 1 AS committed FROM records, (VALUES ('g1'), ('g2')) v(g)
  WHERE "timestamp" < CASE g WHEN 'g1' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-02-20' END GROUP BY ALL)"""


def _committed(records):
    """Offsets of two groups: one stopped on 20 January, the other read everything."""
    known = lambda group, until: records.filter(F.col("timestamp") < F.lit(until).cast("timestamp")).groupBy(
        "topic", "partition").agg((F.max("offset") + 1).alias("committed")).withColumn("group_id", F.lit(group))
    return known("g1", "2024-01-20").unionByName(known("g2", "2024-02-20"))


@query("agg11_consumer_lag", with_(RECORDS, COMMITTED) + """
SELECT c.group_id, c.topic, CAST(sum(committed) AS BIGINT) AS committed, CAST(sum(e.last - committed) AS BIGINT) AS lag
FROM committed c JOIN (SELECT topic, "partition", max("offset") + 1 AS last FROM records GROUP BY 1, 2) e
  ON c.topic = e.topic AND c."partition" = e."partition" GROUP BY 1, 2""")
def agg11(spark, sf):
    records = _records(spark, sf)
    return topics.consumer_lag(records, _committed(records))


@query("agg12_flow_check", with_(RECORDS, COMMITTED) + f"""
SELECT r.topic, r.bytes_in, r.bytes_in > 0 AS flowing, l.queued, l.queued <= 1 AS keeping_up
FROM (SELECT topic, CAST(sum(strlen({RECORD_TEXT})) AS BIGINT) AS bytes_in FROM records GROUP BY 1) r
JOIN (SELECT topic, CAST(max(lag) AS BIGINT) AS queued FROM (
        SELECT c.group_id, c.topic, sum(e.last - committed) AS lag FROM committed c
        JOIN (SELECT topic, "partition", max("offset") + 1 AS last FROM records GROUP BY 1, 2) e
          ON c.topic = e.topic AND c."partition" = e."partition" GROUP BY 1, 2) GROUP BY 1) l ON l.topic = r.topic""")
def agg12(spark, sf):
    records = _records(spark, sf)
    return topics.flow_check(records, 1, topics.consumer_lag(records, _committed(records)))


@query("agg13_word_count", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def agg13(spark, sf):
    return reports.word_count(inputs.load(spark, sf, "documents"), "text")


@query("srt01_newest_rows", with_(READINGS) + """
SELECT sensor_id, sensor_ts, reading_id, sensor_0 FROM readings ORDER BY sensor_ts DESC, reading_id DESC LIMIT 100""")
def srt01(spark, sf):
    return reports.newest(_readings(spark, sf), ORDER).select("sensor_id", "sensor_ts", "reading_id", "sensor_0")


@query("srt02_grouped_newest_first", with_(READINGS) + """
SELECT event_time AS sensor_timestamp, sensor_id, avg(sensor_0) AS avg_sensor_0, avg(sensor_1) AS avg_sensor_1
FROM readings GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 100""")
def srt02(spark, sf):
    return reports.newest(agg06(spark, sf), ["sensor_timestamp", "sensor_id"])


@query("srt03_time_span", with_(READINGS) + "SELECT min(sensor_ts) AS first_ts, max(sensor_ts) AS last_ts FROM readings")
def srt03(spark, sf):
    return reports.time_span(_readings(spark, sf), "sensor_ts")


# --- ordered rows ---------------------------------------------------------

COUNT_WINDOWS = with_(READINGS, """w AS (
  SELECT *, (row_number() OVER (PARTITION BY sensor_id ORDER BY sensor_ts, reading_id) - 1) // 3 AS window_no,
         row_number() OVER (PARTITION BY sensor_id ORDER BY sensor_ts, reading_id) AS pos FROM readings)""") + """
SELECT sensor_id, window_no, CAST(sum(sensor_9) AS BIGINT) AS sum_value, max(sensor_9) AS max_value,
       arg_max(reading_id, (sensor_9, -pos)) AS max_reading_id FROM w GROUP BY 1, 2 HAVING count(*) = 3"""

RUNNING = with_(READINGS) + """
SELECT reading_id, sensor_id, sensor_0, CAST(sum(sensor_0) OVER (PARTITION BY sensor_id ORDER BY sensor_ts, reading_id
       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_sum FROM readings"""


@query("win01_count_windows", COUNT_WINDOWS)
def win01(spark, sf):
    return ordered.count_windows(_readings(spark, sf), ["sensor_id"], ORDER, "sensor_9", 3, ["reading_id"])


@query("win01_count_windows_hot_keys", COUNT_WINDOWS)
def win01_hot(spark, sf):
    return ordered.count_windows(_readings(spark, sf), ["sensor_id"], ORDER, "sensor_9", 3, ["reading_id"], hot_rows=20)


@query("win02_running_sum", RUNNING)
def win02(spark, sf):
    rows = ordered.running_sum(_readings(spark, sf), ["sensor_id"], ORDER, "sensor_0")
    return rows.select("reading_id", "sensor_id", "sensor_0", "running_sum")


@query("win02_running_sum_hot_keys", RUNNING)
def win02_hot(spark, sf):
    rows = ordered.running_sum(_readings(spark, sf), ["sensor_id"], ORDER, "sensor_0", hot_rows=20)
    return rows.select("reading_id", "sensor_id", "sensor_0", "running_sum")


@query("win02_running_sum_then_filter", f"SELECT * FROM ({RUNNING}) WHERE sensor_0 >= 50")
def win02_filter(spark, sf):
    return win02(spark, sf).filter("sensor_0 >= 50")


GAP = """
SELECT {keys}prev AS inactive_from, event_time AS restored_at, epoch_us(event_time) - epoch_us(prev) AS gap_us,
       (epoch_us(event_time) - epoch_us(prev)) // 45000000 AS alerts
FROM (SELECT *, lag(event_time) OVER ({part} ORDER BY event_time) AS prev FROM readings)
WHERE epoch_us(event_time) - epoch_us(prev) > 45000000"""


def _naive_gaps(df):
    return df.withColumns({c: epoch.naive(c) for c in ("inactive_from", "restored_at")})


@query("win03_inactivity_gaps", with_(READINGS) + GAP.format(keys="", part=""))
def win03(spark, sf):
    return _naive_gaps(ordered.inactivity_gaps(_readings(spark, sf)))


@query("win03_inactivity_gaps_per_key", with_(READINGS) + GAP.format(keys="sensor_id, ", part="PARTITION BY sensor_id"))
def win03_key(spark, sf):
    return _naive_gaps(ordered.inactivity_gaps(_readings(spark, sf), ["sensor_id"]))


@query("win03_open_gap", with_(READINGS) + """
SELECT sensor_id, max(event_time) AS last_seen, epoch_us(TIMESTAMP '2024-01-31') - max(epoch_us(event_time)) AS silent_us
FROM readings GROUP BY 1 HAVING epoch_us(TIMESTAMP '2024-01-31') - max(epoch_us(event_time)) > 45000000""")
def win03_open(spark, sf):
    found = ordered.open_gap(_readings(spark, sf), F.lit("2024-01-31 00:00:00").cast("timestamp"), ["sensor_id"])
    return found.withColumn("last_seen", epoch.naive("last_seen"))


@query("win04_latest_per_key", with_(READINGS) + """
SELECT sensor_id, arg_max(reading_id, (sensor_ts, reading_id)) AS reading_id, max(sensor_ts) AS sensor_ts,
       arg_max(sensor_0, (sensor_ts, reading_id)) AS sensor_0 FROM readings GROUP BY 1""")
def win04(spark, sf):
    return ordered.latest_per_key(_readings(spark, sf), ["sensor_id"], ORDER, ["reading_id", "sensor_ts", "sensor_0"])


# --- views ----------------------------------------------------------------

STATS = f"stats AS ({sliding_sql('device_id', PLAUSIBLE)})"
LATEST_STATS = """latest AS (
  SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY "windowEnd" DESC) = 1)"""


def _stats_view(spark, sf):
    return views.latest_state(pipelines.sensor_statistics(_readings(spark, sf)), ["device_id"], ["windowEnd"])


@query("str10_latest_state_with_retention", with_(READINGS, STATS, LATEST_STATS) + """
SELECT * FROM latest WHERE "windowEnd" >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 300 SECOND""")
def str10(spark, sf):
    kept = views.within_retention(_stats_view(spark, sf), F.lit("2024-01-30 20:00:00").cast("timestamp"), "windowEnd")
    return kept.withColumn("windowEnd", epoch.naive("windowEnd"))


@query("str10_ignore_nulls", with_(READINGS) + """
SELECT sensor_id, arg_max(sensor_0, (sensor_ts, reading_id)) FILTER (WHERE sensor_0 % 3 <> 0) AS a,
       arg_max(sensor_1, (sensor_ts, reading_id)) FILTER (WHERE sensor_1 % 2 <> 0) AS b,
       max(sensor_ts) AS sensor_ts, arg_max(reading_id, (sensor_ts, reading_id)) AS reading_id
FROM readings GROUP BY 1""")
def str10_nulls(spark, sf):
    rows = _readings(spark, sf).select(
        "sensor_id", F.when(F.col("sensor_0") % 3 != 0, F.col("sensor_0")).alias("a"),
        F.when(F.col("sensor_1") % 2 != 0, F.col("sensor_1")).alias("b"), "sensor_ts", "reading_id")
    return views.latest_state(rows, ["sensor_id"], ORDER, ignore_nulls=True)


@query("str11_view_query", with_(READINGS, STATS, LATEST_STATS) + """
SELECT * FROM latest WHERE "sensorGreaterThan60" > 0""")
def str11(spark, sf):
    _stats_view(spark, sf).withColumn("windowEnd", epoch.naive("windowEnd")).createOrReplaceTempView("fg_sensor_view")
    return views.query_view(spark, "fg_sensor_view", "above60")


@query("str11_view_query_with_range", with_(READINGS, STATS, LATEST_STATS) + """
SELECT * FROM latest WHERE "sensorGreaterThan60" > 0 AND "sensorAverage" >= 80 AND "sensorAverage" <= 120""")
def str11_range(spark, sf):
    _stats_view(spark, sf).withColumn("windowEnd", epoch.naive("windowEnd")).createOrReplaceTempView("fg_sensor_view")
    return views.query_view(spark, "fg_sensor_view", "above60withRange/80/120")


# --- change capture -------------------------------------------------------

STATE = """{name} AS (
  SELECT id, name FROM (SELECT id, arg_max(op, (ts, seq)) AS op, arg_max(name, (ts, seq)) AS name FROM changes
                        {where} GROUP BY id) WHERE op <> 'd')"""
OLD = STATE.format(name="old_state", where="WHERE ts < epoch_us(TIMESTAMP '2024-01-28')")
NEW = STATE.format(name="new_state", where="")
DIFF = """diff AS (
  SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op,
         o.id AS before_id, o.name AS before_name, n.id AS after_id, n.name AS after_name
  FROM old_state o FULL JOIN new_state n ON o.id = n.id WHERE o.name IS DISTINCT FROM n.name)"""
EVENTS = """log AS (
  SELECT coalesce(before_id, after_id) AS id, 0 AS part, 'd' AS op, before_id, before_name, NULL AS after_id, NULL AS after_name
  FROM diff WHERE op IN ('u', 'd')
  UNION ALL SELECT after_id, CASE op WHEN 'u' THEN 1 ELSE 0 END, 'c', NULL, NULL, after_id, after_name FROM diff WHERE op IN ('u', 'c'))"""


def _states(spark, sf):
    rows = _changes(spark, sf)
    early = rows.filter(F.col("ts") < F.unix_micros(F.lit("2024-01-28 00:00:00").cast("timestamp")))
    return (changes.apply_changes(early, ["id"], ["ts", "seq"]), changes.apply_changes(rows, ["id"], ["ts", "seq"]))


def _flat(df):
    return df.select(*[c for c in df.columns if c not in ("before", "after")],
                     F.col("before.id").alias("before_id"), F.col("before.name").alias("before_name"),
                     F.col("after.id").alias("after_id"), F.col("after.name").alias("after_name"))


def _log(spark, sf):
    diff = changes.capture_diff(*_states(spark, sf), ["id"])
    keyed = diff.withColumn("id", F.coalesce("before.id", "after.id"))
    return changes.encode(keyed, ["id"])


@query("cdc01_capture_snapshot_and_changes", with_(CHANGES, OLD) + """
SELECT 'r' AS op, id, name, CAST(0 AS BIGINT) AS ts FROM old_state
UNION ALL SELECT op, id, name, ts FROM changes WHERE ts >= epoch_us(TIMESTAMP '2024-01-28')""")
def cdc01(spark, sf):
    snapshot, _ = _states(spark, sf)
    later = _changes(spark, sf).filter(F.col("ts") >= F.unix_micros(F.lit("2024-01-28 00:00:00").cast("timestamp")))
    zero = F.lit(0).cast("bigint")
    rows = changes.snapshot_then_changes(snapshot, later, zero, zero)
    image = F.coalesce("after", "before")
    return rows.select("op", image["id"].alias("id"), image["name"].alias("name"), "ts")


@query("cdc01_capture_diff", with_(CHANGES, OLD, NEW, DIFF) + "SELECT * FROM diff")
def cdc01_diff(spark, sf):
    return _flat(changes.capture_diff(*_states(spark, sf), ["id"]))


@query("cdc02_apply_changes", with_(CHANGES, NEW) + "SELECT id, name FROM new_state")
def cdc02(spark, sf):
    return changes.apply_changes(_changes(spark, sf), ["id"], ["ts", "seq"])


@query("cdc03_encode_change_log", with_(CHANGES, OLD, NEW, DIFF, EVENTS) + "SELECT * FROM log")
def cdc03(spark, sf):
    return _flat(_log(spark, sf))


IMAGE_TEXT = """CASE WHEN {s}_id IS NULL THEN 'null' ELSE '{{"id":' || {s}_id || ',"name":"' || {s}_name || '"}}' END"""


@query("snk11_key_and_value_format", with_(CHANGES, OLD, NEW, DIFF, EVENTS) + f"""
SELECT id, part, '{{"id":' || id || '}}' AS key, '{{"before":' || {IMAGE_TEXT.format(s='before')} || ',"after":'
       || {IMAGE_TEXT.format(s='after')} || ',"op":"' || op || '"}}' AS value FROM log""")
def snk11(spark, sf):
    return changes.to_change_json(_log(spark, sf), ["id"]).select("id", "part", "key", "value")


@query("cdc04_decode_change_log", with_(CHANGES, OLD, NEW, DIFF, EVENTS) + "SELECT * FROM log")
def cdc04(spark, sf):
    lines = changes.to_change_json(_log(spark, sf), ["id"]).select("id", "part", "value")
    return _flat(changes.decode(lines, "id bigint, name string")[0].drop("value", "ts_ms"))


@query("cdc05_verify_replica", with_(CHANGES, OLD, NEW, DIFF, EVENTS, """replica AS (
  SELECT id, name FROM old_state WHERE id NOT IN (SELECT before_id FROM log WHERE op = 'd')
  UNION ALL SELECT after_id, after_name FROM log WHERE op = 'c')""") + """
SELECT count(*) = 0 AS same FROM ((SELECT * FROM replica EXCEPT ALL SELECT * FROM new_state)
  UNION ALL (SELECT * FROM new_state EXCEPT ALL SELECT * FROM replica))""")
def cdc05(spark, sf):
    old, new = _states(spark, sf)
    start = old.select(F.lit("c").alias("op"), F.lit(None).cast("struct<id:bigint,name:string>").alias("before"),
                       F.struct("id", "name").alias("after"), F.lit(0).alias("step"), F.lit(0).alias("part"))
    log = _log(spark, sf).select("op", "before", "after", F.lit(1).alias("step"), "part")
    return changes.same_rows(changes.apply_changes(start.unionByName(log), ["id"], ["step", "part"]), new)


@query("set03_differences", with_(CHANGES, OLD, NEW) + """
SELECT id, name, CAST(1 AS BIGINT) AS surplus FROM (SELECT * FROM old_state EXCEPT ALL SELECT * FROM new_state)
UNION ALL SELECT id, name, -1 FROM (SELECT * FROM new_state EXCEPT ALL SELECT * FROM old_state)""")
def set03(spark, sf):
    return changes.differences(*_states(spark, sf))


# --- topics ---------------------------------------------------------------

@query("rte04_topic_selection", with_(RECORDS) + """
SELECT topic, "partition", "offset" FROM records WHERE topic LIKE 'iot/%' AND topic NOT IN ('iot/error', 'iot/view')""")
def rte04(spark, sf):
    return _records(spark, sf).filter(topics.selected_topics("iot/.*", "iot/(error|view)")).select("topic", "partition", "offset")


@query("rep01_replicate_topics", with_(RECORDS) + """
SELECT 'cluster_a.' || topic AS topic, "partition", "offset", key FROM records WHERE topic IN ('iot/click', 'iot/purchase')""")
def rep01(spark, sf):
    copied = topics.replicate(_records(spark, sf), "cluster_a", "iot/(click|purchase)")
    return copied.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"))


BOTH = """sides AS (
  SELECT *, event_id % 2 = 0 AS on_a FROM records WHERE topic = 'iot/click')"""


@query("rep02_two_way_copy", with_(RECORDS, BOTH) + """
SELECT 'a' AS place, 'b.' || topic AS topic, "partition", "offset" FROM sides WHERE NOT on_a
UNION ALL SELECT 'b', 'a.' || topic, "partition", "offset" FROM sides WHERE on_a""")
def rep02(spark, sf):
    clicks = _records(spark, sf).filter("topic = 'iot/click'")
    even = (F.col("offset") * 10 + F.col("partition")) % 2 == 0
    place_a, place_b = clicks.filter(even), clicks.filter(~even)
    # Each place already holds a first round of copies; the next round must not send them back.
    held_b = place_b.unionByName(topics.replicate(place_a, "a", ".*iot/click", target="b"))
    to_a = topics.replicate(held_b, "b", ".*iot/click", target="a").withColumn("place", F.lit("a"))
    held_a = place_a.unionByName(topics.replicate(place_b, "b", ".*iot/click", target="a"))
    to_b = topics.replicate(held_a, "a", ".*iot/click", target="b").withColumn("place", F.lit("b"))
    return to_a.unionByName(to_b).select("place", "topic", "partition", "offset")


@query("rep03_continuity_gap", """
SELECT max(epoch_us(ts)) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS last_before,
       min(epoch_us(ts)) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS first_after,
       (min(epoch_us(ts)) FILTER (WHERE ts >= TIMESTAMP '2024-01-15')
        - max(epoch_us(ts)) FILTER (WHERE ts < TIMESTAMP '2024-01-15')) // 1000000 AS gap_seconds FROM events""")
def rep03(spark, sf):
    records = _records(spark, sf)
    cut = F.col("timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    return topics.continuity_gap(records.filter(cut), records.filter(~cut))


@query("set01_snapshot_then_changes", with_(CHANGES) + """
SELECT op, count(*) AS n FROM (SELECT 'r' AS op FROM customer UNION ALL SELECT op FROM changes) GROUP BY op""")
def set01(spark, sf):
    table = inputs.load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    zero = F.lit(0).cast("bigint")
    return reports.count_by(changes.snapshot_then_changes(table, _changes(spark, sf), zero, zero), ["op"], "n")


@query("set02_topic_with_replicas", with_(RECORDS) + """
SELECT topic, "partition", "offset" FROM records WHERE topic = 'iot/click'
UNION ALL SELECT 'cluster_b.' || topic, "partition", "offset" FROM records WHERE topic = 'iot/click'""")
def set02(spark, sf):
    records = _records(spark, sf)
    both = records.unionByName(topics.replicate(records, "cluster_b", "iot/click"))
    return topics.with_replicas(both, "iot/click").select("topic", "partition", "offset")


# --- model ----------------------------------------------------------------

def _frame(spark, sf):
    return inputs.training_frame(inputs.load(spark, sf, "events"))


@query("ml01_index_columns", with_(READINGS, """ranks AS (
  SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx FROM (
    SELECT CAST(sensor_1 AS VARCHAR) || '.0' AS v, count(*) AS n FROM readings GROUP BY 1))""") + """
SELECT CAST(sensor_1 AS DOUBLE) AS value, CAST(idx AS DOUBLE) AS indexed, count(*) AS n
FROM readings JOIN ranks ON v = CAST(sensor_1 AS VARCHAR) || '.0' GROUP BY 1, 2""")
def ml01(spark, sf):
    return model.index_columns(_frame(spark, sf)).groupBy(F.col("1").alias("value"), F.col("1_indexed").alias("indexed")).agg(
        F.count(F.lit(1)).alias("n"))


@query("ml02_split")
def ml02(spark, sf):
    train, test = model.split_frame(_frame(spark, sf), 0.7, 7)
    return reports.row_count(train).withColumn("part", F.lit("train")).unionByName(
        reports.row_count(test).withColumn("part", F.lit("test")))


@query("ml04_train_and_evaluate")
def ml04(spark, sf):
    metrics, _ = pipelines.train_and_choose(_frame(spark, sf), settings=[(10, 5)])
    return metrics


@query("ml06_best_of_experiments")
def ml06(spark, sf):
    """The three tried settings; the metrics of each run."""
    metrics, _ = pipelines.train_and_choose(_frame(spark, sf))
    return metrics


@query("ml05_confusion")
def ml05(spark, sf):
    train, test = model.split_frame(_frame(spark, sf), 0.7, 7)
    fitted = model.health_pipeline(10, 5).fit(train)
    return reports.confusion(model.score(fitted, test, "prediction"), "12")


@query("ml07_score_table")
def ml07(spark, sf):
    fitted = model.health_pipeline(10, 5).fit(_frame(spark, sf))
    rows = _readings(spark, sf).select(
        "reading_id", *[F.col(f"sensor_{i}").cast("double").alias(str(i)) for i in range(12)])
    return model.score(fitted, rows).select("reading_id", "result")


# --- reports, SQL on tables -----------------------------------------------

@query("snk01_publish_json", with_(READINGS) + """
SELECT '{"sensor_id":' || sensor_id || '}' AS key, '{"sensor_id":' || sensor_id || ',"sensor_ts":' || sensor_ts
       || ',"sensor_0":' || sensor_0 || ',"is_healthy":' || is_healthy || '}' AS value, 'iot_enriched' AS topic FROM readings""")
def snk01(spark, sf):
    rows = _readings(spark, sf).select("sensor_id", "sensor_ts", "sensor_0", "is_healthy")
    published = sinks.json_records(rows, "iot_enriched", ["sensor_id"])
    return published.select(text.decode_bytes("key").alias("key"), text.decode_bytes("value").alias("value"), "topic")


@query("snk07_insert_with_column_list", with_(TRANSACTIONS, CUSTOMERS, FRAUDS) + """
SELECT event_time, account_id AS acc_id, txn2_id AS transaction_id, f_name, l_name, email, gender, phone, card, lat, lon,
       CAST(amount AS BIGINT) AS amount FROM frauds""")
def snk07(spark, sf):
    found = joins.frauds(_transactions(spark, sf), _customers(spark, sf))
    rows = joins.fraud_table_rows(found)
    return rows.withColumn("event_time", epoch.naive(F.col("event_time").cast("timestamp")))


@query("snk09_preview", with_(READINGS) + """
SELECT arg_min(reading_id, (event_time, reading_id)) AS reading_id FROM readings GROUP BY date_trunc('hour', event_time)""")
def snk09(spark, sf):
    return sinks.preview(_readings(spark, sf), "event_time", 3_600_000, ["reading_id"]).select("reading_id")


@query("snk13_headers", with_(RECORDS) + """
SELECT topic, "partition", "offset", 'schema.name' AS header, schema_name AS value FROM records""")
def snk13(spark, sf):
    from ..sources.records import header_value

    rows = _records(spark, sf).withColumn("schema.name", header_value(r"schema\.name"))
    chosen = sinks.matching_headers(rows, r"schema.*")
    sent = rows.drop("headers").withColumn("headers", sinks.header_column(chosen))
    return sent.select("topic", "partition", "offset", F.inline("headers").alias("header", "value")).withColumn(
        "value", F.col("value").cast("string"))
