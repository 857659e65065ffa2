"""The reference data model, derived from the test tables.

``events`` become sensor readings, topic records, payments and a change log;
``customer`` becomes the customer dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.epoch import epoch_us, floor_div
from ..session import new_folder
from ..sources.schemas import READING_WIRE, SENSOR_COLUMNS


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream (the pattern fits a file as well as a folder of files)."""
    schema = load(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


FEED_FILE_ROWS = 10_000  # a part of fewer rows for each of its files is one file


def feed(spark: SparkSession, sf_dir: str, name: str, time: str, folder: str, parts: int = 8, files: int = 8,
         most: int | None = None) -> DataFrame:
    """The table as a stream in time order: ``parts`` micro-batches of up to ``files`` files each.

    With ``most`` a part of more rows is cut into micro-batches of about so many at most.
    """
    rows = load(spark, sf_dir, name)
    files = add_in_time_order(rows, time, folder, parts, files, most)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def add_in_time_order(rows: DataFrame, time: str, folder: str, parts: int = 1, files: int = 8,
                      most: int | None = None) -> int:
    """Add the rows to a folder that a stream reads, part by part in time order; returns the files of each part.

    One pass over the table deals its rows to the parts; each part is then added in turn, by as many tasks as it
    has files, as the file source takes files by their time of writing.
    """
    spark = rows.sparkSession
    us = F.unix_micros(F.col(time).cast("timestamp"))
    ends = rows.agg(F.min(us).alias("first"), F.max(us).alias("last")).first()
    first, last = ends["first"] or 0, ends["last"] or 0
    part = F.coalesce(floor_div(us - first, (last - first) // parts + 1), F.lit(0)).cast("int")
    if most:
        part = _cut(rows, part, us, most)
    path = new_folder(spark, "feed-parts")
    rows.withColumn("_part", part).write.partitionBy("_part").parquet(path)
    dealt = spark.read.schema(T.StructType([*rows.schema, T.StructField("_part", T.IntegerType())])).parquet(path)
    sizes = {r["_part"]: r["count"] for r in dealt.groupBy("_part").count().collect()}
    if not sizes:
        rows.write.mode("append").parquet(folder)
    if min(sizes.values(), default=0) < FEED_FILE_ROWS * files:
        files = 1
    for n in sorted(sizes):
        dealt.filter(F.col("_part") == n).select(*rows.columns).repartition(files).write.mode("append").parquet(folder)
    return files


def _cut(rows: DataFrame, part: Column, us: Column, most: int) -> Column:
    """Numbers of finer parts: all are cut at quantiles of their times so that none has many more rows than ``most``."""
    rows = rows.select(part.alias("part"), us.alias("us"))
    pieces = -(-(rows.groupBy("part").count().agg(F.max("count")).first()[0] or 0) // most)
    if pieces < 2:
        return part
    ends = F.percentile_approx("us", [i / pieces for i in range(1, pieces)], 100 * pieces)
    finer = F.lit(0)
    for found in rows.groupBy("part").agg(ends.alias("ends")).collect():
        above = sum((F.coalesce(us > end, F.lit(False)).cast("int") for end in found["ends"] or []), F.lit(0))
        finer = F.when(part == found["part"], above).otherwise(finer)
    return part * pieces + finer


def sensor_value(i: int) -> Column:
    if i == 0:
        return F.floor(F.col("value") * 2).cast("int")
    if i in (1, 6):
        return F.floor("value").cast("int")
    return ((F.col("event_id") * i) % 100).cast("int")


def readings(events: DataFrame) -> DataFrame:
    """Sensor readings with whole-number values; sensor_0 goes above 500."""
    return events.select(
        F.col("user_id").cast("int").alias("sensor_id"),
        epoch_us("ts").alias("sensor_ts"),
        *[sensor_value(i).alias(c) for i, c in enumerate(SENSOR_COLUMNS)],
        (F.col("event_type") != "error").cast("int").alias("is_healthy"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("reading_id"),
    )


def topic_records(events: DataFrame) -> DataFrame:
    """Readings as records of topics ``iot/<event type>``; every seventh has no response record."""
    response = F.when(F.col("event_id") % 7 != 0, F.struct(
        (F.col("event_type") != "error").cast("int").alias("result")))
    wire = F.struct(
        F.col("user_id").cast("int").alias("sensor_id"),
        epoch_us("ts").alias("sensor_ts"),
        F.lit(None).cast("int").alias("is_healthy"),
        response.alias("response"),
        *[sensor_value(i).alias(c) for i, c in enumerate(SENSOR_COLUMNS)],
    )
    assert [f.name for f in READING_WIRE][:4] == ["sensor_id", "sensor_ts", "is_healthy", "response"]
    schema_name = F.when(F.col("event_id") % 5 == 0, "TransactionEvent").otherwise("SensorReading")
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(wire).cast("binary").alias("value"),
        F.concat(F.lit("iot/"), F.col("event_type")).alias("topic"),
        (F.col("event_id") % 10).cast("int").alias("partition"),
        F.call_function("div", F.col("event_id"), F.lit(10).cast("bigint")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.array(
            header("schema.name", schema_name),
            header("client.id", F.concat(F.lit("producer-"), (F.col("event_id") % 3).cast("string"))),
        ).alias("headers"),
    )


def transactions(events: DataFrame) -> DataFrame:
    """Payments; ``ts`` in milliseconds."""
    score = (F.col("event_id") % 100) / F.lit(100.0)
    return events.select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.floor("value").cast("int").alias("amount"),
        (F.lit(-37.0) + (F.col("event_id") % 10) * F.lit(0.5)).alias("lat"),
        (F.lit(144.0) + (F.col("event_id") % 7) * F.lit(0.5)).alias("lon"),
        score.alias("fraud_score"),
        F.struct(score.alias("fraud_score")).alias("model_response"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def raw_transactions(events: DataFrame) -> DataFrame:
    """Payments as the text lines a client sends."""
    line = F.struct(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.floor("value").cast("int").alias("amount"),
        (F.lit(-37.0) + (F.col("event_id") % 10) * F.lit(0.5)).alias("lat"),
        (F.lit(144.0) + (F.col("event_id") % 7) * F.lit(0.5)).alias("lon"),
    )
    return events.select(F.to_json(line).alias("value"))


def customers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return customer.select(
        key.alias("acc_id"),
        F.substring_index("c_name", "#", 1).alias("f_name"),
        F.substring_index("c_name", "#", -1).alias("l_name"),
        F.concat(F.lit("c"), key, F.lit("@example.com")).alias("email"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("+00"), key).alias("phone"),
        F.col("c_mktsegment").alias("card"),
    )


def change_rows(events: DataFrame) -> DataFrame:
    """One change per event: sign-ups create, errors delete, the rest update; no before image."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    row = F.struct(F.col("user_id").alias("id"),
                   F.concat_ws("-", F.col("event_type"), F.col("event_id").cast("string")).alias("name"))
    return events.select(
        op.alias("op"),
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        epoch_us("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def training_frame(events: DataFrame) -> DataFrame:
    """Columns ``0`` … ``11`` and the label ``12``: healthy unless two readings are high together."""
    label = F.when((sensor_value(1) > 40) & (sensor_value(3) > 30), 0).otherwise(1)
    return events.select(*[sensor_value(i).cast("double").alias(str(i)) for i in range(12)],
                         label.cast("int").alias("12"))
