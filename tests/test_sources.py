import os

import pytest
from pyspark.sql import functions as F

from flowgauge.plans import inputs
from flowgauge.sources import catalog, readers, records, schemas
from flowgauge.streaming import jobs, sinks


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_malformed_json_is_set_aside(spark):
    df = texts(spark, '{"a": 1, "b": 2}', '{"a": 1', "", "[1]", '{"b": 3}', None)
    good, bad = records.parse_or_quarantine(df, "a int, b int", required=["a"])
    assert [(r["a"], r["b"]) for r in good.collect()] == [(1, 2)]
    assert sorted((r["reason"], r["decoded"] or "") for r in bad.collect()) == [
        ("missing field", '{"b": 3}'), ("unreadable", ""), ("unreadable", ""), ("unreadable", "[1]"),
        ("unreadable", '{"a": 1')]


def test_field_of_a_wrong_type_makes_a_record_unreadable(spark):
    good, bad = records.parse_or_quarantine(texts(spark, '{"a": "x"}'), "a int")
    assert good.count() == 0 and bad.count() == 1


def test_message_with_an_array_or_one_object(spark):
    df = texts(spark, '[{"a":1},{"a":2}]', '{"a":3}', "[]", "bad")
    assert sorted(r["a"] for r in records.parse_json_array(df, "a int")[0].select("data.a").filter("a is not null").collect()) == [1, 2, 3]


def test_schema_by_header_and_unknown_schema(spark):
    header = lambda n, v: [(n, bytearray(v.encode()))]
    df = spark.createDataFrame(
        [(bytearray(b'{"a":1}'), header("schema.name", "A")), (bytearray(b'{"b":2}'), header("schema.name", "B")),
         (bytearray(b'{"c":3}'), header("schema.name", "C")), (bytearray(b'{"a":4}'), None)],
        "value binary, headers array<struct<key:string,value:binary>>")
    parts = records.parse_by_schema_name(df, {"A": "a int", "B": "b int"}, records.header_value("schema.*"))
    assert parts["A"].first()["a"] == 1 and parts["B"].first()["b"] == 2 and parts["unmatched"].count() == 2


def test_detect_schema_of_a_sample(spark):
    df = texts(spark, *['{"a": 1, "b": {"c": "x"}, "d": 1.5}'] * 50)
    got = records.detect_schema(df, sample=0.5)
    assert got.simpleString() == "struct<a:bigint,b:struct<c:string>,d:double>"


def test_detect_schema_merges_and_skips_bad_texts(spark):
    df = texts(spark, '{"a": 1, "e": null}', '{"a": 2.5, "c": [1, 2]}', "no json", '{"b": true, "a": 3, "m": 1}', '{"m": "x"}', None)
    assert records.detect_schema(df).simpleString() == "struct<a:double,b:boolean,c:array<bigint>,e:string,m:string>"


def test_newer_schema_reads_older_rows(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, city string")
    assert sorted((r["a"], r["city"]) for r in records.read_as_newest([new, old]).collect()) == [(1, None), (2, "x")]


def test_kafka_starts():
    provider = {"type": "kafka", "bootstrap.servers": "h:1"}
    assert readers.kafka_options(provider, "t", start="1970-01-01 00:00:02")["startingTimestamp"] == "2000"
    assert "startingOffsets" not in readers.kafka_options(provider, "t", start="1970-01-01 00:00:02")
    assert readers.kafka_options(provider, "t", start='{"t":{"0":5}}')["startingOffsets"] == '{"t":{"0":5}}'


def test_large_tables_are_read_in_parts(spark):
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, url="u", table="t", driver="d")
    with pytest.raises(ValueError):
        readers.jdbc_options("u", "t", "d", partition_column="id")


def test_kafka_options():
    provider = {"type": "kafka", "bootstrap.servers": "h:9092", "security.protocol": "SSL"}
    got = readers.kafka_options(provider, "iot", start="earliest", max_per_batch=10)
    assert got == {"kafka.bootstrap.servers": "h:9092", "kafka.security.protocol": "SSL", "subscribe": "iot",
                   "startingOffsets": "earliest", "includeHeaders": "true", "maxOffsetsPerTrigger": "10"}
    assert readers.kafka_options(provider, ".*iot", pattern=True)["subscribePattern"] == ".*iot"


def test_jdbc_options():
    got = readers.jdbc_options("jdbc:x", "t", "d", "u", "p", partition_column="id", lower=0, upper=9, partitions=3)
    assert got["dbtable"] == "t" and got["partitionColumn"] == "id" and got["numPartitions"] == "3"
    assert "user" not in readers.jdbc_options("jdbc:x", "t", "d")


@pytest.mark.parametrize("filter_text, topic, matches", [
    ("iot/#", "iot/a/b", True), ("iot/#", "other/a", False), ("iot/+/x", "iot/a/x", True),
    ("iot/+/x", "iot/a/b/x", False), ("a.b", "a.b", True), ("a.b", "aXb", False)])
def test_topic_pattern(filter_text, topic, matches):
    import re
    assert bool(re.fullmatch(readers.topic_pattern(filter_text), topic)) is matches


def test_providers():
    readers.create_provider("p1", "files", path="/x")
    assert readers.get_provider("p1")["path"] == "/x" and "p1" in readers.list_providers()
    readers.drop_provider("p1")
    assert "p1" not in readers.list_providers()


def test_latest_skips_files_already_there(spark, folder, sf):
    rows = inputs.topic_records(inputs.load(spark, sf, "events"))
    rows.limit(20).write.parquet(folder)
    for name in os.listdir(folder):
        os.utime(f"{folder}/{name}", (1_000_000_000, 1_000_000_000))
    provider = {"type": "files", "path": folder}
    count = lambda start, out: _count(spark, readers.read_topic(spark, provider, "iot/.*", pattern=True, start=start), out)
    assert count("latest", folder + "-l") == 0
    assert count("earliest", folder + "-e") == 20


def _count(spark, df, out):
    jobs.run_available(df, "count", path=out)
    return spark.read.schema(df.schema).parquet(out).count()


def test_registered_stream_is_queried_by_sql(spark, folder, sf):
    inputs.topic_records(inputs.load(spark, sf, "events")).write.parquet(folder)
    catalog.register_stream_table(
        spark, "iot_live", {"type": "files", "path": folder}, "iot/click", schemas.READING_WIRE,
        event_time=F.timestamp_micros("sensor_ts"), start="earliest")
    result = spark.sql("""SELECT sensor_id, window(event_time, '10 seconds').end AS windowEnd, count(*) AS n
                          FROM iot_live GROUP BY sensor_id, window(event_time, '10 seconds')""")
    assert result.isStreaming
    jobs.run_available(result, "sql-stream", path=folder + "-out")
    got = spark.read.parquet(folder + "-out").agg(F.sum("n")).first()[0]
    clicks = inputs.load(spark, sf, "events").filter("event_type = 'click'").count()
    assert clicks - 3 <= got <= clicks


def test_broker_time_is_the_row_time_by_default(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "a int, s string").select("a", F.col("s").cast("timestamp").alias("timestamp"))
    assert catalog.register_rows(df, "plain").columns == ["a", "event_time"]


def test_table_life_cycle(spark, folder):
    catalog.drop_table(spark, "life")
    for _ in range(2):
        catalog.create_table(spark, "life", "a int, b string", folder, buckets=4, bucket_by=["a"])
    assert "life" in catalog.list_tables(spark)
    info = {r["col_name"]: r["data_type"] for r in catalog.table_info(spark, "life").collect()}
    assert info["a"] == "int" and info["Num Buckets"] == "4"
    catalog.drop_table(spark, "life")
    assert "life" not in catalog.list_tables(spark)


def test_json_records_with_key_headers_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "A")], "a int, b int, `schema.name` string")
    row = sinks.json_records(df.select("a", "b"), "t", ["a"], {"schema.name": "S"}, keep_nulls=True).first()
    assert (bytes(row["key"]), bytes(row["value"])) == (b'{"a":1}', b'{"a":1,"b":null}')
    assert [(h["key"], bytes(h["value"])) for h in row["headers"]] == [("schema.name", b"S")]
    assert sinks.matching_headers(df, "schema.*") == {"schema.name": "col:`schema.name`"}


def test_preview_of_every_row(spark):
    df = spark.range(3)
    assert sinks.preview(df, "id", 0) is df


def test_rows_are_dropped_only_at_five_hundred(spark):
    from flowgauge.operators import quality

    df = spark.createDataFrame([(499, 1), (500, 1), (1, 500), (None, 600), (None, 3), (None, None)], "sensor_0 int, sensor_1 int")
    assert quality.drop_implausible(df).count() == 3
    parts = quality.split(df, error=quality.implausible())
    assert parts["error"].count() == 3 and parts["unmatched"].count() == 3


def test_topics_that_came_from_the_target_are_not_sent_back(spark):
    from flowgauge.operators import topics

    df = spark.createDataFrame([("iot",), ("b.iot",), ("x.iot",), ("iot2",)], "topic string")
    got = [r["topic"] for r in topics.replicate(df, "a", ".*iot", target="b").collect()]
    assert sorted(got) == ["a.iot", "a.x.iot"]
    assert [r["topic"] for r in df.filter(topics.selected_topics("iot.*", "iot2")).collect()] == ["iot"]


def test_overlap_is_a_negative_gap(spark):
    from flowgauge.operators import topics

    before = texts(spark, 'ts 1579006137000000 and 1579006139500000')
    after = texts(spark, "1579006137000000", "no number")
    assert topics.continuity_gap(before, after).first()["gap_seconds"] == -2


def test_lag_of_a_partition_never_committed(spark):
    from flowgauge.operators import topics

    recs = spark.createDataFrame([("t", 0, 9), ("t", 1, 4)], "topic string, partition int, offset bigint")
    committed = spark.createDataFrame([("g", "t", 0, 8)], "group_id string, topic string, partition int, committed bigint")
    row = topics.consumer_lag(recs, committed).first()
    assert (row["committed"], row["lag"]) == (8, 7)


def test_messages_that_cannot_be_read_are_set_aside(spark):
    texts = ['[{"a":1},{"a":2}]', '{"a":3}', 'not json', '[{"a":4},', '[1, 2]', '[{"a":5}, "x"]', '[]', '', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    good, bad = records.parse_json_array(df, "a int")
    assert sorted((r["i"], r["data"]["a"]) for r in good.collect()) == [(0, 1), (0, 2), (1, 3)]
    assert sorted((r["i"], r["decoded"], r["reason"]) for r in bad.collect() if r["i"] != 8) == [
        (i, texts[i], "unreadable") for i in (2, 3, 4, 5, 7)]
    assert [r["i"] for r in bad.collect() if r["decoded"] is None] == [8]


def test_readable_and_unreadable_records_add_up(spark):
    texts = ['{"a":1}', 'x{"a":2}', '', '{"a":', '[1]', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert records.parse_json_flat(df, "a int").count() + records.unreadable(df, "a int").count() == len(texts)
    named = df.withColumn("n", F.lit("s"))
    parts = records.parse_by_schema_name(named, {"s": "a int"}, F.col("n"))
    assert parts["s"].count() + parts["unreadable"].count() + parts["unmatched"].count() == len(texts)


def test_replicas_of_a_topic_with_signs(spark):
    from flowgauge.operators import topics

    df = spark.createDataFrame([("a+b",), ("r.a+b",), ("aab",), ("xa+b",)], "topic string")
    assert sorted(r["topic"] for r in topics.with_replicas(df, "a+b").collect()) == ["a+b", "r.a+b"]


def test_avro_is_refused_without_its_module(spark, folder):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1,)], "a int")
    if not sinks.has_avro(spark):
        with pytest.raises(RuntimeError):
            sinks.write_avro(df, folder, T.StructType.fromDDL("a int"))
    sinks.write_avro(df, folder, T.StructType.fromDDL("a int"), fmt="parquet")
    assert spark.read.parquet(folder).count() == 1
