import pytest
from pyspark.sql import functions as F

from flowgauge.plans import inputs, pipelines
from flowgauge.operators import model
from flowgauge.sources import schemas
from flowgauge.streaming import jobs, keyed, sinks
from tests.streams import Feed

SCHEMA = "k string, t bigint, v int"


def test_start_list_and_stop(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add([("a", 1, 1)])
    jobs.start_job(feed.stream(), "named", path=folder + "-out", every="1 second")
    assert "named" in jobs.list_jobs(spark)
    assert jobs.stop_job(spark, "named")
    assert "named" not in jobs.list_jobs(spark) and not jobs.stop_job(spark, "named")


def test_resume_goes_on_and_a_fresh_start_reads_again(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add([("a", 1, 1)])
    seen = []
    sink = lambda b, n: seen.append(sorted(r["k"] for r in b.collect()))
    checkpoint = folder + "-checkpoint"
    jobs.run_available(feed.stream(), "resume", each_batch=sink, checkpoint=checkpoint)
    feed.add([("b", 2, 2)])
    jobs.run_available(feed.stream(), "resume", each_batch=sink, checkpoint=checkpoint)
    assert seen == [["a"], ["b"]]                      # the snapshot is not read again
    jobs.run_available(feed.stream(), "resume", each_batch=sink)
    assert seen[2:] == [["a"], ["b"]]


def test_console(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add([("shown", 1, 1)])
    job = jobs.start_job(feed.stream(), "console", every=None, fmt="console")
    job.awaitTermination()
    assert sum(p["numInputRows"] for p in job.recentProgress) == 1
    assert "Console" in job.recentProgress[-1]["sink"]["description"]


def test_console_is_sent_only_what_it_may_show(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add([(f"k{i}", i, i) for i in range(1000)])
    job = jobs.start_job(feed.stream(), "console-few", every=None, fmt="console", numRows=2)
    job.awaitTermination()
    done = [p for p in job.recentProgress if p["numInputRows"]]
    assert [(p["numInputRows"], p["sink"]["numOutputRows"]) for p in done] == [(1000, 3)]


def test_first_of_each_task_are_the_first_in_order(spark):
    rows = spark.range(0, 30_000, 1, 3).select("id", F.array("id").alias("a"))
    assert [r["id"] for r in sinks.first_of_each_task(rows, 2).collect()] == [0, 1, 10_000, 10_001, 20_000, 20_001]


def test_insert_into_a_table_and_update_mode(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add([("a", 1, 1)]).add([("a", 2, 5), ("b", 2, 1)])
    spark.sql("DROP TABLE IF EXISTS inserted")
    jobs.run_available(feed.stream(), "insert", table="inserted")
    assert spark.table("inserted").count() == 3
    spark.sql("DROP TABLE IF EXISTS inserted")
    sums = []
    jobs.run_available(feed.stream().groupBy("k").agg(F.sum("v").alias("s")), "update", mode="update",
                       each_batch=lambda b, n: sums.extend(map(tuple, b.collect())))
    assert sorted(sums) == [("a", 1), ("a", 6), ("b", 1)]


def test_empty_outputs_are_skipped(spark, folder):
    written = []
    sink = sinks.routed({"low": lambda d: d.filter("v < 5"), "high": lambda d: d.filter("v >= 5")},
                        {n: (lambda d, i, n=n: written.append((n, i))) for n in ("low", "high")})
    sink(spark.createDataFrame([("a", 1, 1)], SCHEMA), 0)
    sink(spark.createDataFrame([], SCHEMA), 1)
    assert written == [("low", 0)]


def test_preview_of_a_stream(spark, folder):
    schema = "id bigint, event_time timestamp"
    rows = lambda *s: spark.createDataFrame([(i, x) for i, x in enumerate(s)], "id bigint, s double").select(
        "id", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("event_time"))
    feed = Feed(spark, folder, schema).add(rows(0.1, 0.2, 1.5)).add(rows(1.6, 2.1)).add(rows(9.0))
    shown = sinks.preview(feed.stream().withWatermark("event_time", "3 seconds"), "event_time", 1000)
    jobs.run_available(shown, "preview", path=folder + "-out")
    assert spark.read.parquet(folder + "-out").count() == 3


def test_preview_of_a_stream_with_an_interval_longer_than_the_watermark(spark, folder):
    schema = "id bigint, event_time timestamp"
    minutes = lambda *m: spark.createDataFrame([(x,) for x in m], "id bigint").select(
        "id", F.timestamp_micros(F.col("id") * 60_000_000).alias("event_time"))
    feed = Feed(spark, folder, schema)
    for part in ((0, 1), (10, 11), (20, 21), (30, 31), (50,), (70, 61), (130,)):
        feed.add(minutes(*part))
    shown = sinks.preview(feed.stream().withWatermark("event_time", "3 seconds"), "event_time", 3_600_000)
    jobs.run_available(shown, "preview", path=folder + "-out")
    assert sorted(r["id"] for r in spark.read.parquet(folder + "-out").collect()) == [0, 61]


def test_edge_pipeline_edges(spark):
    rows = [("iot/1", '{"sensor_ts":1000000,"sensor_0":1,"sensor_1":2}', 1.0),
            ("iot/1", '{"sensor_ts":1000000,"sensor_0":500,"sensor_1":2}', 1.0),       # implausible
            ("iot/1", '{"sensor_ts":1000000,"sensor_1":2}', 1.0),                        # one field is enough
            ("iot/1", '{"sensor_ts":1000000}', 1.0),                                     # both missing
            ("iot/1", '{"sensor_ts":1000000,"sensor_0":1,"sensor_1":2}', 61.0),          # exactly 60 s old
            ("iot/1", '{"sensor_ts":1000000,"sensor_0":1,"sensor_1":2}', 61.1),          # too old
            ("other", '{"sensor_ts":1000000,"sensor_0":1,"sensor_1":2}', 1.0)]
    df = spark.createDataFrame(rows, "topic string, v string, s double").select(
        "topic", F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("timestamp"))
    published, bad = pipelines.edge_to_topic(df, "iot/#")
    assert published.count() == 3 and bad.count() == 1
    assert {r["topic"] for r in published.collect()} == {"iot"}


def test_enrichment_quarantines_and_fills(spark, folder):
    df = spark.createDataFrame([('{"sensor_id":1,"sensor_ts":1,"sensor_0":3}',), ("{bad",),
                                ('{"sensor_id":2,"sensor_ts":2,"response":{"result":1}}',)], "value string")
    failed = []
    sink = pipelines.enriched_sink(f"{folder}/t", f"{folder}/j", f"{folder}/a",
                                   avro_format="parquet", failures=lambda d, n: failed.append(d.count()), default_result=F.lit(0))
    sink(df, 0)
    stored = keyed.read_keyed(spark, f"{folder}/t", schemas.TABLE_KEYS["sensors"])
    assert {r["sensor_id"]: r["is_healthy"] for r in stored.collect()} == {1: 0, 2: 1}
    assert dict(stored.dtypes)["sensor_0"] == "double"
    assert failed == [1] and spark.read.parquet(f"{folder}/j").count() == 2
    assert spark.read.parquet(f"{folder}/a").count() == 2


# --- model ------------------------------------------------------------------

@pytest.fixture(scope="module")
def frame(spark, sf):
    return inputs.training_frame(inputs.load(spark, sf, "events")).persist()


def golden(spark):
    """The two published scoring inputs."""
    rows = [(0.0, 65.0, 0.0, 137.0, 21.95, 83.0, 19.42, 111.0, 9.4, 6.0, 3.43, 4.0),
            (0.0, 95.0, 0.0, 88.0, 26.62, 75.0, 21.05, 115.0, 8.65, 5.0, 3.32, 3.0)]
    return spark.createDataFrame(rows, ", ".join(f"`{i}` double" for i in range(12)))


def test_train_save_load_score(spark, frame, folder):
    metrics, best = pipelines.train_and_choose(frame, f"{folder}/model", settings=[(3, 2), (5, 4)])
    assert metrics.count() == 2 and metrics.agg(F.max("auroc")).first()[0] > 0.5
    loaded = model.load_model(f"{folder}/model")
    # Unseen values of the indexed column are scored too.
    scored = model.score(loaded, golden(spark)).collect()
    assert len(scored) == 2 and {r["result"] for r in scored} <= {0, 1}
    names = model.importances(best)
    assert list(names) == model.FEATURES and sum(names.values()) == pytest.approx(1.0)


def test_scores_on_a_stream_equal_the_batch(spark, frame, folder):
    fitted = model.health_pipeline(3, 3).fit(frame)
    frame.limit(100).write.parquet(folder)
    rows = spark.readStream.schema(frame.schema).parquet(folder)
    jobs.run_available(model.score(fitted, rows), "score", path=folder + "-out")
    got = spark.read.parquet(folder + "-out").groupBy("result").count().collect()
    want = model.score(fitted, spark.read.parquet(folder)).groupBy("result").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_indexed_column_as_a_category(spark, frame):
    categories = frame.select("1").distinct().count()
    model.health_pipeline(2, 2, as_category=True, max_bins=max(32, categories + 1)).fit(frame)


def test_evaluation_with_soft_scores(spark, frame):
    fitted = model.health_pipeline(3, 3).fit(frame)
    scored = model.score(fitted, frame)
    assert model.evaluate(scored, score_col="p_healthy")["auroc"] >= model.evaluate(scored)["auroc"] - 0.05


def test_training_rows_in_one_partition_are_dealt_to_the_cores(spark):
    rows = spark.range(0, 1000, 1, 1)
    dealt = model.spread(rows, 200)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * 250
    assert dealt.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()[:] == (1000, 1000, 499_500)
    for same, n in ((spark.range(0, 1000, 1, 1), 1000), (spark.range(0, 1000, 1, 4), 200), (spark.range(0), 200)):
        assert model.spread(same, n).rdd.getNumPartitions() == same.rdd.getNumPartitions()


def test_experiments_train_in_more_than_the_partitions_read(spark, frame, monkeypatch):
    seen = []
    monkeypatch.setattr(model, "experiments", lambda train, test, settings, path=None: seen.extend(
        p.filter("`12` IS NOT NULL").select(F.spark_partition_id()).distinct().count() for p in (train, test)))
    monkeypatch.setattr(model.spread, "__defaults__", (100,))
    pipelines.train_and_choose(frame.coalesce(1))
    assert min(seen) > 1


def test_enrichment_with_the_model(spark, frame):
    fitted = model.health_pipeline(3, 3).fit(frame)
    values = ",".join(f'"sensor_{i}":{i}' for i in range(12))
    df = spark.createDataFrame([('{"sensor_id":1,"sensor_ts":1,%s}' % values,)], "value string")
    good, _ = pipelines.enrich(df, fitted)
    row = good.first()
    assert row["is_healthy"] == row["response"]["result"] and row["is_healthy"] in (0, 1)
