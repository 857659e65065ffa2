"""Queries for scalar functions, projections, filters and routing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import epoch, geo, named, text
from ..operators import quality, shape
from ..session import new_folder
from ..sources import records as rec, schemas
from . import inputs
from .registry import (READINGS, RECORD_TEXT, RECORDS, SENSOR_LIST, TRANSACTIONS, km_sql, query, with_)

AS_OF = "2024-01-20 12:00:00"


def _readings(spark, sf):
    return inputs.readings(inputs.load(spark, sf, "events"))


def _records(spark, sf):
    return inputs.topic_records(inputs.load(spark, sf, "events"))


def _transactions(spark, sf):
    return inputs.transactions(inputs.load(spark, sf, "events"))


# --- time -----------------------------------------------------------------

@query("fn01_rescale_epoch", with_(READINGS) + """
SELECT reading_id, (sensor_ts + 500) // 1000 AS ms, (sensor_ts + 500000) // 1000000 AS s, sensor_ts * 1000 AS ns
FROM readings""")
def fn01(spark, sf):
    return _readings(spark, sf).select(
        "reading_id", epoch.rescale_epoch("sensor_ts", "us", "ms").alias("ms"),
        epoch.rescale_epoch("sensor_ts", "us", "s").alias("s"), epoch.rescale_epoch("sensor_ts", "us", "ns").alias("ns"))


@query("fn02_ms_to_timestamp", "SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def fn02(spark, sf):
    return _transactions(spark, sf).select(
        F.col("transaction_id").cast("bigint").alias("event_id"),
        epoch.naive(epoch.timestamp_from_ms_floored("ts")).alias("event_time"))


@query("fn03_us_to_timestamp", "SELECT event_id AS reading_id, ts AS sensor_timestamp FROM events")
def fn03(spark, sf):
    return _readings(spark, sf).select(
        "reading_id", epoch.naive(epoch.timestamp_from_us("sensor_ts")).alias("sensor_timestamp"))


@query("fn04_text_to_epoch_ms", "SELECT event_id, epoch_ms(date_trunc('second', ts)) AS ts_ms FROM events")
def fn04(spark, sf):
    lines = inputs.raw_transactions(inputs.load(spark, sf, "events"))
    rows = rec.parse_json_flat(lines, schemas.TRANSACTION_RAW)
    return rows.select(F.col("transaction_id").cast("bigint").alias("event_id"), epoch.text_to_epoch_ms("ts").alias("ts_ms"))


@query("fn05_elapsed_ms", with_(TRANSACTIONS) + """
SELECT transaction_id, ts - epoch_ms(TIMESTAMP '2024-01-01') AS since_ms FROM transactions""")
def fn05(spark, sf):
    start = F.unix_millis(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return _transactions(spark, sf).select("transaction_id", epoch.elapsed_ms(F.col("ts"), start).alias("since_ms"))


@query("fn06_time_shift", """
SELECT event_id AS reading_id, ts + INTERVAL 10 MINUTE AS later, ts - INTERVAL 3 SECOND AS earlier FROM events""")
def fn06(spark, sf):
    return _readings(spark, sf).select(
        "reading_id", epoch.naive(epoch.shift_time("event_time", "10 minutes")).alias("later"),
        epoch.naive(epoch.shift_time("event_time", "3 seconds", back=True)).alias("earlier"))


@query("fn07_case_when", with_(READINGS) + """
SELECT reading_id, CASE WHEN sensor_6 > 70 THEN 1 ELSE 0 END AS over FROM readings""")
def fn07(spark, sf):
    return _readings(spark, sf).select("reading_id", F.when(F.col("sensor_6") > 70, 1).otherwise(0).alias("over"))


# --- text -----------------------------------------------------------------

@query("fn08_json_round_trip", with_(READINGS) + """
SELECT reading_id, '{"sensor_id":' || sensor_id || ',"sensor_ts":' || sensor_ts || ',"sensor_6":' || sensor_6 || '}' AS json,
       sensor_ts AS back FROM readings""")
def fn08(spark, sf):
    rows = _readings(spark, sf).select(
        "reading_id", F.to_json(F.struct("sensor_id", "sensor_ts", "sensor_6")).alias("json"))
    return rows.withColumn("back", F.from_json("json", "sensor_ts bigint")["sensor_ts"])


@query("fn09_json_path", with_(RECORDS) + """
SELECT topic, "partition", "offset", CAST(sensor_0 AS DOUBLE) AS sensor_0, CAST(sensor_1 AS DOUBLE) AS sensor_1, result
FROM records""")
def fn09(spark, sf):
    rows = _records(spark, sf).withColumn("body", text.decode_bytes("value"))
    return rows.select("topic", "partition", "offset", text.json_value("body", "$.sensor_0").alias("sensor_0"),
                       text.json_value("body", "$.sensor_1").alias("sensor_1"),
                       text.json_value("body", "$.response.result", "int").alias("result"))


@query("fn10_regex_capture", with_(RECORDS) + """
SELECT topic, "partition", "offset", CAST(sensor_0 AS DOUBLE) AS sensor_0, CAST(sensor_11 AS DOUBLE) AS sensor_11
FROM records""")
def fn10(spark, sf):
    rows = _records(spark, sf).withColumn("body", text.decode_bytes("value"))
    return rows.select("topic", "partition", "offset", text.number_after_name("body", "sensor_0").alias("sensor_0"),
                       text.number_after_name("body", "sensor_11").alias("sensor_11"))


@query("fn11_digit_runs", """
SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{10,}')) AS run FROM documents
UNION ALL SELECT -1 - event_id, CAST(epoch_us(ts) AS VARCHAR) FROM events""")
def fn11(spark, sf):
    docs = inputs.load(spark, sf, "documents").select("doc_id", "text")
    messages = _records(spark, sf).select(
        (F.lit(-1) - (F.col("offset") * 10 + F.col("partition"))).alias("doc_id"), text.decode_bytes("value").alias("text"))
    return text.digit_runs(docs.unionByName(messages), "text").select("doc_id", "run")


@query("fn12_replace_whole_text", """
SELECT doc_id, '{"fraud_score": 0.' || doc_id || '}' AS reply, '<' || text || '>' AS wrapped FROM documents""")
def fn12(spark, sf):
    docs = inputs.load(spark, sf, "documents")
    return docs.select(
        "doc_id",
        F.regexp_replace(text.replace_whole("text", '{"fraud_score": 0.#}'), "#", F.col("doc_id").cast("string")).alias("reply"),
        text.replace_whole("text", "<$1>").alias("wrapped"))


@query("fn13_feature_text", with_(READINGS) + """
SELECT reading_id, concat_ws(', ', sensor_1, sensor_0, sensor_2, sensor_3, sensor_4, sensor_5, sensor_6, sensor_7,
       sensor_8, sensor_9, sensor_10, sensor_11) AS feature FROM readings""")
def fn13(spark, sf):
    order = ["sensor_1", "sensor_0"] + [f"sensor_{i}" for i in range(2, 12)]
    return _readings(spark, sf).select("reading_id", text.feature_text(order).alias("feature"))


@query("fn14_feature_numbers", with_(READINGS) + """
SELECT reading_id, 12 AS n, CAST(sensor_1 AS DOUBLE) AS first_value, CAST(sensor_11 AS DOUBLE) AS last_value,
       CAST(sensor_0 + sensor_1 + sensor_2 + sensor_3 + sensor_4 + sensor_5 + sensor_6 + sensor_7 + sensor_8
            + sensor_9 + sensor_10 + sensor_11 AS DOUBLE) AS total FROM readings""")
def fn14(spark, sf):
    numbers = fn13(spark, sf).withColumn("v", text.feature_numbers("feature"))
    return numbers.select(
        "reading_id", F.size("v").alias("n"), F.get("v", F.lit(0)).alias("first_value"),
        F.element_at("v", -1).alias("last_value"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("fn15_integer_division", with_(READINGS) + """
SELECT reading_id, sensor_ts // 1000000 AS seconds, -(sensor_ts // 1000000) AS negative FROM readings""")
def fn15(spark, sf):
    return _readings(spark, sf).select(
        "reading_id", epoch.truncating_div("sensor_ts", 1_000_000).alias("seconds"),
        epoch.truncating_div(-F.col("sensor_ts"), 1_000_000).alias("negative"))


@query("fn16_trigonometry", with_(TRANSACTIONS) + """
SELECT transaction_id, round(radians(lat), 9) AS rad, round(sin(radians(lat)), 9) AS s, round(cos(radians(lon)), 9) AS c,
       round(atan2(lat, lon), 9) AS a, round(sqrt(lon), 9) AS r FROM transactions""")
def fn16(spark, sf):
    return _transactions(spark, sf).select(
        "transaction_id", F.round(F.radians("lat"), 9).alias("rad"), F.round(F.sin(F.radians("lat")), 9).alias("s"),
        F.round(F.cos(F.radians("lon")), 9).alias("c"), F.round(F.atan2("lat", "lon"), 9).alias("a"),
        F.round(F.sqrt("lon"), 9).alias("r"))


@query("fn17_decode_bytes", with_(RECORDS) + f"""
SELECT topic, "partition", "offset", key, {RECORD_TEXT} AS body FROM records""")
def fn17(spark, sf):
    return _records(spark, sf).select("topic", "partition", "offset", text.decode_bytes("key").alias("key"),
                                      text.decode_bytes("value").alias("body"))


@query("fn18_stub_result", with_(READINGS) + """
SELECT reading_id, CAST(CAST('0x' || substr(md5('0|' || sensor_id || '|' || sensor_ts), 1, 8) AS BIGINT) % 2 AS INTEGER) AS result
FROM readings""")
def fn18(spark, sf):
    return _readings(spark, sf).select("reading_id", text.stub_result(["sensor_id", "sensor_ts"]).alias("result"))


@query("fn19_log_axis", with_(READINGS) + """
SELECT reading_id, CASE WHEN sensor_0 > 0 THEN round(log10(sensor_0), 9) END AS log_0 FROM readings""")
def fn19(spark, sf):
    return _readings(spark, sf).select("reading_id", F.round(text.log_axis("sensor_0"), 9).alias("log_0"))


@query("fn20_text_cast", with_(TRANSACTIONS) + """
SELECT transaction_id, CAST(ts AS VARCHAR) AS ts, CAST(amount AS VARCHAR) AS amount FROM transactions""")
def fn20(spark, sf):
    return _transactions(spark, sf).select("transaction_id", text.as_text("ts").alias("ts"), text.as_text("amount").alias("amount"))


@query("geo01_distance", with_(TRANSACTIONS) + f"""
SELECT transaction_id, round({km_sql('lat', 'lon', 'CAST(-37.8 AS DOUBLE)', 'CAST(144.9 AS DOUBLE)')}, 6) AS km
FROM transactions""")
def geo01(spark, sf):
    return _transactions(spark, sf).select(
        "transaction_id", F.round(geo.haversine_km("lat", "lon", F.lit(-37.8), F.lit(144.9)), 6).alias("km"))


@query("udf01_named_function", with_(TRANSACTIONS) + f"""
SELECT transaction_id, round({km_sql('lat', 'lon', 'CAST(-37.8 AS DOUBLE)', 'CAST(144.9 AS DOUBLE)')}, 6) AS km,
       account_id AS acc_id FROM transactions""")
def udf01(spark, sf):
    named.register_builtin(spark)
    _transactions(spark, sf).createOrReplaceTempView("fg_payments")
    return spark.sql("""SELECT transaction_id, round(HAVETOKM(lat, lon, -37.8D, 144.9D), 6) AS km,
                               TO_KUDU_STRING(account_id) AS acc_id FROM fg_payments""")


@query("udf02_find_and_drop_functions", with_(TRANSACTIONS) + f"""
SELECT transaction_id, round({km_sql('lat', 'lon', 'CAST(-37.8 AS DOUBLE)', 'CAST(144.9 AS DOUBLE)')}, 6) AS km,
       1 AS found, 0 AS left_over FROM transactions""")
def udf02(spark, sf):
    """A function found by its name in other letters, used over the table, and dropped."""
    named.register_builtin(spark)
    before = named.find_functions(spark, "HaveToKm")
    _transactions(spark, sf).createOrReplaceTempView("fg_payments")
    rows = spark.sql(f"SELECT transaction_id, round({before[0]}(lat, lon, -37.8D, 144.9D), 6) AS km FROM fg_payments")
    path = new_folder(spark, "distances")
    rows.write.parquet(path)
    named.drop_function(spark, "HaveToKm")
    after = named.find_functions(spark, "havetokm")
    return spark.read.parquet(path).withColumns({"found": F.lit(len(before)), "left_over": F.lit(len(after))})


@query("udf03_batch_function_in_sql", with_(READINGS) + """
SELECT reading_id, CASE WHEN sensor_1 > 40 AND sensor_3 > 30 THEN 0 ELSE 1 END AS result FROM readings""")
def udf03(spark, sf):
    @F.pandas_udf("int")
    def health_rule(a: pd.Series, b: pd.Series) -> pd.Series:
        return (~((a > 40) & (b > 30))).astype("int32")

    named.create_python_function(spark, "health_rule", health_rule)
    _readings(spark, sf).createOrReplaceTempView("fg_readings")
    return spark.sql("SELECT reading_id, health_rule(sensor_1, sensor_3) AS result FROM fg_readings")


@query("udf04_map_filter_flatmap", with_(READINGS) + """
SELECT sensor_id, reading_id, unnest([sensor_9, sensor_10]) AS reading FROM readings WHERE sensor_9 >= 50""")
def udf04(spark, sf):
    rows = _readings(spark, sf).filter("sensor_9 >= 50")
    return rows.select("sensor_id", "reading_id", F.explode(F.array("sensor_9", "sensor_10")).alias("reading"))


# --- projections ----------------------------------------------------------

@query("prj01_select_columns", with_(READINGS) + """
SELECT event_time, sensor_id, sensor_0, sensor_1, is_healthy FROM readings""")
def prj01(spark, sf):
    return _readings(spark, sf).select(
        epoch.naive("event_time").alias("event_time"), "sensor_id", "sensor_0", "sensor_1", "is_healthy")


@query("prj02_flatten_nested", with_(RECORDS) + """
SELECT sensor_id, sensor_ts, result, sensor_6 FROM records""")
def prj02(spark, sf):
    rows = rec.parse_json(_records(spark, sf), schemas.READING_WIRE)
    return shape.flatten(rows, {"sensor_id": "data.sensor_id", "sensor_ts": "data.sensor_ts",
                                "result": "data.response.result", "sensor_6": "data.sensor_6"})


@query("prj03_rename", with_(TRANSACTIONS) + "SELECT transaction_id AS txn, account_id AS acc_id, amount FROM transactions")
def prj03(spark, sf):
    rows = _transactions(spark, sf).select("transaction_id", "account_id", "amount")
    return shape.rename(rows, {"transaction_id": "txn", "account_id": "acc_id"})


@query("prj04_cast", with_(READINGS) + """
SELECT reading_id, CAST(sensor_6 AS FLOAT) AS sensor_6, CAST(sensor_0 AS DOUBLE) AS sensor_0,
       TRY_CAST(CAST(sensor_id AS VARCHAR) AS INTEGER) AS sensor_id FROM readings""")
def prj04(spark, sf):
    rows = _readings(spark, sf).select("reading_id", "sensor_6", "sensor_0", F.col("sensor_id").cast("string"))
    return shape.cast_columns(rows, {"sensor_6": "float", "sensor_0": "double", "sensor_id": "int"})


@query("prj05_assign_path", with_(RECORDS) + "SELECT sensor_id, sensor_ts, result AS is_healthy FROM records")
def prj05(spark, sf):
    rows = rec.parse_json_flat(_records(spark, sf), schemas.READING_WIRE)
    return shape.assign_path(rows, "is_healthy", "response.result").select("sensor_id", "sensor_ts", "is_healthy")


@query("prj06_insert_record", with_(TRANSACTIONS) + """
SELECT transaction_id, CAST(CASE WHEN amount > 100 THEN 0.95 ELSE 0.05 END AS DOUBLE) AS score, amount AS seen
FROM transactions""")
def prj06(spark, sf):
    score = F.when(F.col("amount") > 100, 0.95).otherwise(0.05)
    rows = shape.insert_record(_transactions(spark, sf), "model_response", {"fraud_score": score, "seen": F.col("amount")})
    return shape.flatten(rows, {"transaction_id": "transaction_id", "score": "model_response.fraud_score",
                                "seen": "model_response.seen"})


@query("prj07_fill_nested_default", with_(RECORDS) + """
SELECT sensor_id, sensor_ts, coalesce(result, sensor_3 % 2) AS result FROM records""")
def prj07(spark, sf):
    rows = rec.parse_json_flat(_records(spark, sf), schemas.READING_WIRE)
    filled = shape.fill_nested(rows, "response.result", F.col("sensor_3") % 2)
    return filled.select("sensor_id", "sensor_ts", F.col("response.result").alias("result"))


@query("prj08_tag_constant", with_(READINGS) + "SELECT reading_id, 'SensorReading' AS schema_name FROM readings")
def prj08(spark, sf):
    return shape.tag(_readings(spark, sf).select("reading_id"), schema_name="SensorReading")


@query("prj09_transform_hook", with_(READINGS) + """
SELECT reading_id, (sensor_ts + 500) // 1000 AS sensor_ts, sensor_6 * 2 AS sensor_6 FROM readings""")
def prj09(spark, sf):
    rows = _readings(spark, sf).select("reading_id", "sensor_ts", "sensor_6")
    return shape.apply_hooks(
        rows, lambda d: d.withColumn("sensor_ts", epoch.rescale_epoch("sensor_ts", "us", "ms")),
        lambda d: d.withColumn("sensor_6", F.col("sensor_6") * 2))


# --- filters --------------------------------------------------------------

@query("flt01_drop_implausible", with_(READINGS) + f"""
SELECT reading_id, {SENSOR_LIST} FROM readings WHERE NOT coalesce(sensor_0 >= 500 OR sensor_1 >= 500, false)""")
def flt01(spark, sf):
    return quality.drop_implausible(_readings(spark, sf)).select("reading_id", *schemas.SENSOR_COLUMNS)


@query("flt02_equality", with_(READINGS) + "SELECT sensor_id, sensor_ts FROM readings WHERE is_healthy = 0")
def flt02(spark, sf):
    return _readings(spark, sf).filter("is_healthy = 0").select("sensor_id", "sensor_ts")


@query("flt03_score_threshold", with_(TRANSACTIONS) + """
SELECT transaction_id, fraud_score FROM transactions WHERE fraud_score > 0.90""")
def flt03(spark, sf):
    return quality.above_score(_transactions(spark, sf)).select("transaction_id", "fraud_score")


@query("flt04_bound_parameters", with_(READINGS) + """
SELECT reading_id, sensor_6 FROM readings WHERE sensor_6 >= 20 AND sensor_6 <= 80 AND sensor_0 > 0""")
def flt04(spark, sf):
    _readings(spark, sf).createOrReplaceTempView("fg_readings")
    return quality.bound_query(
        spark, "SELECT reading_id, sensor_6 FROM fg_readings WHERE sensor_6 >= :low AND sensor_6 <= :high AND sensor_0 > 0",
        {"low": 20, "high": 80})


@query("flt05_recent", with_(READINGS) + f"""
SELECT reading_id FROM readings WHERE event_time > TIMESTAMP '{AS_OF}' - INTERVAL 60 SECOND""")
def flt05(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp")
    return quality.recent(_readings(spark, sf), as_of, 60, epoch="sensor_ts").select("reading_id")


@query("flt06_lower_bound", with_(READINGS) + "SELECT reading_id, sensor_0 FROM readings WHERE sensor_0 >= 50")
def flt06(spark, sf):
    return _readings(spark, sf).filter("sensor_0 >= 50").select("reading_id", "sensor_0")


@query("flt07_inequality", with_(READINGS) + """
SELECT reading_id, sensor_2, sensor_3 FROM readings WHERE sensor_2 <> sensor_3 AND sensor_4 > sensor_5""")
def flt07(spark, sf):
    return _readings(spark, sf).filter("sensor_2 <> sensor_3 AND sensor_4 > sensor_5").select("reading_id", "sensor_2", "sensor_3")


@query("flt08_expire", """
SELECT event_id AS reading_id FROM events WHERE event_id % 120 <= 60""")
def flt08(spark, sf):
    rows = _readings(spark, sf).withColumn(
        "ingest_time", F.timestamp_micros(F.col("sensor_ts") + (F.col("reading_id") % 120) * 1_000_000))
    return quality.expire(rows, "ingest_time").select("reading_id")


@query("flt09_range_profile", with_(READINGS) + """
SELECT sensor, min(reading) AS min_reading, max(reading) AS max_reading,
       CAST(sum(CASE WHEN reading < 0 OR reading > 100 THEN 1 ELSE 0 END) AS BIGINT) AS out_of_range,
       CAST(sum(CASE WHEN reading > 150 THEN 1 ELSE 0 END) AS BIGINT) AS suspicious
FROM (""" + " UNION ALL ".join(f"SELECT 'sensor_{i}' AS sensor, sensor_{i} AS reading FROM readings" for i in range(12)) + """)
GROUP BY sensor""")
def flt09(spark, sf):
    return quality.range_profile(_readings(spark, sf), schemas.SENSOR_COLUMNS)


@query("flt09_unpivot", with_(READINGS) +
       " UNION ALL ".join(f"SELECT reading_id, 'sensor_{i}' AS sensor, sensor_{i} AS reading FROM readings" for i in range(12)))
def flt09_unpivot(spark, sf):
    rows = quality.unpivot_readings(_readings(spark, sf), ["reading_id"], schemas.SENSOR_COLUMNS)
    return rows


@query("rte01_named_routes", with_(TRANSACTIONS) + """
SELECT 'flattened' AS route, account_id AS account, transaction_id, CAST(amount AS BIGINT) AS amount, fraud_score FROM transactions
UNION ALL SELECT 'to_kudu', account_id, transaction_id, amount, fraud_score FROM transactions
UNION ALL SELECT 'likely_fraud', account_id, transaction_id, amount, fraud_score FROM transactions WHERE fraud_score > 0.90""")
def rte01(spark, sf):
    from .pipelines import payment_routes

    parts = quality.route(_transactions(spark, sf), payment_routes())
    frames = [
        df.withColumnRenamed("acc_id", "account_id")
        .select(F.lit(name).alias("route"), F.col("account_id").alias("account"), "transaction_id",
                F.col("amount").cast("bigint").alias("amount"), "fraud_score")
        for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("rte02_split_with_rest", with_(READINGS) + """
SELECT CASE WHEN sensor_0 >= 500 OR sensor_1 >= 500 THEN 'error' ELSE 'unmatched' END AS route, count(*) AS n,
       CAST(sum(sensor_0) AS BIGINT) AS total FROM readings GROUP BY 1""")
def rte02(spark, sf):
    parts = quality.split(_readings(spark, sf), error=quality.implausible())
    tagged = [df.withColumn("route", F.lit(name)) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sensor_0").alias("total"))
