import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import ordered
from flowgauge.streaming import jobs, stateful
from flowgauge.streaming.keyed import compact
from tests.streams import Feed

SCHEMA = "k string, t bigint, id bigint, v bigint"


def ordered_rows(n=200, seed=1):
    r = random.Random(seed)
    return [(r.choice(["hot", "hot", "hot", "a", "b"]), 10 * i, i, r.randint(0, 9)) for i in range(n)]


def feed_of(spark, folder, rows, parts):
    feed = Feed(spark, folder + "-in", spark.createDataFrame([], SCHEMA).schema)
    size = -(-len(rows) // parts)
    for p in range(parts):
        feed.add(rows[size * p: size * p + size])
    return feed


def fed_with_upkeep(feed, sink, path, checkpoint, every=2):
    """Feed a stream batch by batch, folding the state between the runs."""
    spark = feed.spark
    files = feed.n
    source = Feed(spark, feed.folder + "-again", feed.schema)
    for n in range(files):
        source.add(spark.read.parquet(f"{feed.folder}/part-{n:04d}.parquet"))
        jobs.run_available(source.stream(), "fed", each_batch=sink, checkpoint=checkpoint)
        if n % every:
            compact(spark, f"{path}/state", ["k"])


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_count_windows_across_batches_equal_the_batch_operator(spark, folder, hot_rows):
    feed = feed_of(spark, folder, ordered_rows(), 5)
    sink = stateful.count_window_sink(folder, ["k"], ["t", "id"], "v", 3, ["id"], hot_rows, buckets=2)
    fed_with_upkeep(feed, sink, folder, folder + "-checkpoint")
    got = spark.read.parquet(f"{folder}/windows").drop("batch_id")
    want = ordered.count_windows(feed.batch(), ["k"], ["t", "id"], "v", 3, ["id"])
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_batch_of_one_key_reads_and_writes_one_bucket_of_state(spark, folder):
    import glob

    keys = [(f"k{i}", 0, i, 1) for i in range(60)]
    sink = stateful.count_window_sink(folder, ["k"], ["t", "id"], "v", buckets=8)
    sink(spark.createDataFrame(keys, SCHEMA), 0)
    files = lambda: set(glob.glob(f"{folder}/state/rows/*/*/*/*.parquet"))
    before = files()
    read = []
    original = stateful.read_keyed
    try:
        stateful.read_keyed = lambda *a, **k: read.append(original(*a, **k)) or read[-1]
        sink(spark.createDataFrame([("k7", 1, 100, 5)], SCHEMA), 1)
    finally:
        stateful.read_keyed = original
    assert len(before) == 8 and len(read[0].inputFiles()) == 1 and len(files() - before) == 1


def test_count_windows_conserve_rows(spark, folder):
    rows = ordered_rows(100, 3)
    feed = feed_of(spark, folder, rows, 4)
    jobs.run_available(feed.stream(), "cw2", each_batch=stateful.count_window_sink(folder, ["k"], ["t", "id"], "v"))
    from flowgauge.streaming.keyed import read_keyed

    windows = spark.read.parquet(f"{folder}/windows").count()
    waiting = read_keyed(spark, f"{folder}/state", ["k"]).agg(F.sum(F.when(F.col("waiting").isNotNull(), F.size("waiting")).otherwise(0))).first()[0]
    assert 3 * windows + waiting == len(rows)


def test_repeated_batch_gives_the_same_windows(spark, folder):
    rows = ordered_rows(60, 5)
    frames = [spark.createDataFrame(rows[i:i + 20], SCHEMA) for i in (0, 20, 40)]
    sink = stateful.count_window_sink(folder, ["k"], ["t", "id"], "v")
    for n, df in [(0, frames[0]), (1, frames[1]), (1, frames[1]), (2, frames[2]), (2, frames[2])]:
        sink(df, n)
    got = spark.read.parquet(f"{folder}/windows").drop("batch_id")
    want = ordered.count_windows(spark.createDataFrame(rows, SCHEMA), ["k"], ["t", "id"], "v")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_running_sum_across_batches(spark, folder):
    rows = ordered_rows(120, 7)
    feed = feed_of(spark, folder, rows, 4)
    sink = stateful.running_sum_sink(folder, ["k"], ["t", "id"], "v", keep=lambda d: d.filter("v >= 5"), buckets=3)
    fed_with_upkeep(feed, sink, folder, folder + "-checkpoint")
    totals, expected = defaultdict(int), {}
    for k, _, i, v in rows:
        totals[k] += v
        if v >= 5:
            expected[i] = totals[k]
    got = spark.read.parquet(f"{folder}/rows").collect()
    assert {r["id"]: r["running_sum"] for r in got} == expected


MONITOR = "event_time timestamp, k string"


def monitor(spark, folder, batches, key=None):
    feed = Feed(spark, folder + "-in", MONITOR)
    for b in batches:
        feed.add(spark.createDataFrame(b, "s double, k string").select(
            F.timestamp_micros(((F.col("s") + 1000) * 1_000_000).cast("bigint")).alias("event_time"), "k"))
    jobs.run_available(feed.stream(), "monitor", each_batch=stateful.monitor_sink(folder, 45, key=key, buckets=2))
    got = stateful.each_alert(stateful.read_messages(spark, folder)).collect()
    return sorted((r["at_us"] // 1_000_000 - 1000, r["state"], r["monitor"], r["alert"]) for r in got)


def test_monitor_repeats_while_inactive_and_reports_the_end(spark, folder):
    got = monitor(spark, folder, [[(0.0, "a"), (45.0, "a")], [(200.0, "a")], [(210.0, "a")]])
    assert got == [(90, "inactive", "all", 1), (135, "inactive", "all", 2), (180, "inactive", "all", 3),
                   (200, "restored", "all", 3)]


def test_monitor_of_one_silent_key_fires_on_the_watermark(spark, folder):
    # Key b goes silent while key a keeps the watermark moving.
    batches = [[(0.0, "a"), (0.0, "b")]] + [[(20.0 * i, "a")] for i in range(1, 8)]
    got = monitor(spark, folder, batches, key="k")
    assert (45, "inactive", "b", 1) in got and (90, "inactive", "b", 2) in got
    assert not [g for g in got if g[2] == "a"] and not [g for g in got if g[1] == "restored"]


def test_monitor_ignores_order_inside_a_batch(spark, folder):
    assert monitor(spark, folder, [[(100.0, "a"), (0.0, "a"), (50.0, "a"), (30.0, "a")]]) == [
        (95, "inactive", "all", 1), (100, "restored", "all", 1)]


def seconds(spark, rows):
    return spark.createDataFrame(rows, "s bigint, k string").select(F.timestamp_seconds("s").alias("event_time"), "k")


def test_a_gap_of_fifty_years_is_one_row(spark, folder):
    sink = stateful.monitor_sink(folder)
    year = 365 * 86400
    sink(seconds(spark, [(0, "a")]), 0)
    sink(seconds(spark, [(50 * year, "a")]), 1)
    got = sorted(map(tuple, stateful.read_messages(spark, folder).drop("monitor", "batch_id").collect()))
    assert got == [("inactive", 45_000_000, 45_000_000, 1, 50 * year // 45),
                   ("restored", 50 * year * 1_000_000, 50 * year * 1_000_000, 50 * year // 45, 0)]


def test_monitor_fires_in_parts_that_add_up_and_repeats_batches(spark, folder):
    sink = stateful.monitor_sink(folder, key="k", buckets=2)
    batches = [[(0, "a"), (0, "b")], [(120, "a")], [(120, "a"), (50, "a")], [(400, "a")], [(401, "b")]]
    for n, rows in enumerate(batches):
        for _ in range(1 + n % 2):
            sink(seconds(spark, rows), n)
    got = sorted(map(tuple, stateful.read_messages(spark, folder).select("monitor", "state", "silent_us", "alert", "repeats").collect()))
    s = 1_000_000
    assert got == [("a", "inactive", 45 * s, 1, 2), ("a", "inactive", 45 * s, 1, 6), ("a", "restored", 120 * s, 2, 0),
                   ("a", "restored", 280 * s, 6, 0), ("b", "inactive", 45 * s, 1, 2), ("b", "inactive", 135 * s, 3, 6),
                   ("b", "restored", 401 * s, 8, 0)]


def test_heartbeats_move_the_clock_alone(spark, folder):
    sink = stateful.monitor_sink(folder, beat="beat")
    sink(seconds(spark, [(0, "a")]).withColumn("beat", F.lit(False)), 0)
    sink(seconds(spark, [(100, None)]).withColumn("beat", F.lit(True)), 1)
    sink(seconds(spark, [(150, "a")]).withColumn("beat", F.lit(False)), 2)
    got = sorted(map(tuple, stateful.read_messages(spark, folder).select("state", "silent_us", "alert", "repeats").collect()))
    s = 1_000_000
    assert got == [("inactive", 45 * s, 1, 2), ("inactive", 135 * s, 3, 1), ("restored", 150 * s, 3, 0)]


def test_monitor_over_batches_equals_the_batch_operator(spark, folder):
    r = random.Random(9)
    t, rows = 0, []
    for i in range(300):
        t += r.choice([1, 5, 20, 44, 45, 46, 200])
        rows.append((t, r.choice("abc")))
    for key, keys in (("k", ["k"]), (None, [])):
        path = f"{folder}-{key}"
        sink = stateful.monitor_sink(path, key=key, buckets=2)
        for n in range(6):
            sink(seconds(spark, rows[50 * n:50 * n + 50]), n)
        got = stateful.read_messages(spark, path).filter("state = 'restored'").select("monitor", "at_us", "silent_us", "alert")
        gaps = ordered.inactivity_gaps(seconds(spark, rows), keys)
        want = gaps.select((F.col("k") if key else F.lit("all")).alias("monitor"), F.unix_micros("restored_at").alias("at_us"),
                           F.col("gap_us").alias("silent_us"), F.col("alerts").alias("alert"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        told = stateful.read_messages(spark, path).filter("state = 'inactive'").groupBy(
            "monitor", (F.col("at_us") - F.col("silent_us")).alias("from_us")).agg(
            F.sum("repeats").alias("n"), F.min("alert").alias("first"), F.max(F.col("alert") + F.col("repeats") - 1).alias("last"))
        alerts = {(m, f): (n, a, b) for m, f, n, a, b in map(tuple, told.collect())}
        for m, at, silent, due in map(tuple, want.collect()):
            assert alerts.pop((m, at - silent)) == (due, 1, due)
        assert all(f > max(s for s, k in rows if m in (k, "all")) * 10**6 - 1 for m, f in alerts)  # only gaps still open
