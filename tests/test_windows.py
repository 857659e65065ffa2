import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowgauge.operators import timewindows
from flowgauge.plans import pipelines
from flowgauge.streaming import jobs
from tests.streams import Feed

SCHEMA = "sensor_id int, event_time timestamp, sensor_0 int, sensor_1 int, sensor_6 int"


def at(us):
    return F.timestamp_micros(F.lit(us))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "sensor_id int, us bigint, sensor_0 int, sensor_1 int, sensor_6 int")
    return df.select("sensor_id", F.timestamp_micros("us").alias("event_time"), "sensor_0", "sensor_1", "sensor_6")


def plain(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size, slide", [("30 seconds", "1 second"), ("10 seconds", "5 seconds"), ("10 seconds", "3 seconds")])
def test_folded_windows_equal_sparks_own(spark, size, slide):
    r = random.Random(1)
    rows = [(r.randint(1, 3), r.randint(0, 100) * 500_000, 1, 1, r.choice([None, *range(60, 80)])) for _ in range(300)]
    df = frame(spark, rows)
    direct = df.groupBy("sensor_id", F.window("event_time", size, slide).alias("_w")).agg(
        *timewindows._window_stats("sensor_6", 70))
    direct = direct.select("sensor_id", F.col("_w.end").alias("windowEnd"), *timewindows.STATS)
    got = timewindows.sliding_stats(df, size=size, slide=slide)
    key = lambda d: sorted(d.collect(), key=lambda x: (x["sensor_id"], x["windowEnd"]))
    assert key(got) == key(direct)


def test_row_on_a_boundary_belongs_to_the_next_window(spark):
    df = frame(spark, [(1, 10_000_000, 1, 1, 5)])
    got = timewindows.tumbling_sum(df).withColumn("end", F.unix_seconds("windowEnd"))
    assert got.first()["end"] == 20


def test_threshold_is_strict(spark):
    df = frame(spark, [(1, 0, 1, 1, 70), (1, 1, 1, 1, 71)])
    assert {r["sensorGreaterThan60"] for r in timewindows.sliding_stats(df).collect()} == {1}


def test_stream_equals_batch_and_keeps_rows_three_seconds_late(spark, folder):
    feed = Feed(spark, folder, SCHEMA)
    r = random.Random(2)
    newest = seen = 0
    for part in range(4):
        rows = []
        for _ in range(40):
            newest += r.randint(0, 700_000)
            rows.append((r.randint(1, 3), max(0, newest - r.choice([0, 0, 2_900_000])), 1, 1, r.randint(1, 100)))
            seen = max(seen, rows[-1][1])
        feed.add(frame(spark, rows))
    stream = feed.stream().withWatermark("event_time", "3 seconds")
    out = folder + "-out"
    stats = pipelines.sensor_statistics(stream, "10 seconds", "2 seconds")
    jobs.run_available(stats, "parity", path=out)
    got = spark.read.schema(stats.schema).parquet(out)
    closed = at(seen // 1000 * 1000) - F.expr("INTERVAL 3 SECONDS")
    batch = pipelines.sensor_statistics(feed.batch(), "10 seconds", "2 seconds").filter(F.col("windowEnd") <= closed)
    assert plain(got) == plain(batch) and got.count() > 20


def test_row_behind_the_watermark_is_dropped(spark, folder):
    feed = Feed(spark, folder, SCHEMA)
    feed.add(frame(spark, [(1, 100_000_000, 1, 1, 1)]))
    feed.add(frame(spark, [(1, 101_000_000, 1, 1, 1)]))      # late rows are judged by the watermark one batch back
    feed.add(frame(spark, [(1, 60_000_000, 1, 1, 1)]))       # 40 s late: every window of it is closed
    feed.add(frame(spark, [(1, 200_000_000, 1, 1, 1)]))
    stream = feed.stream().withWatermark("event_time", "3 seconds")
    out = folder + "-out"
    jobs.run_available(timewindows.tumbling_sum(stream), "late", path=out)
    got = spark.read.parquet(out)
    assert plain(got.select(F.unix_seconds("windowEnd"), "total")) == [(110, 2)]


def test_processing_time_window(spark):
    df = frame(spark, [(1, 0, 4, 1, 1), (1, 1, 5, 1, 1)])
    assert timewindows.tumbling_sum(df, time=None).agg(F.sum("total")).first()[0] == 9


def test_processing_time_window_of_a_stream(spark, folder):
    feed = Feed(spark, folder, SCHEMA).add(frame(spark, [(1, 0, 4, 1, 1), (1, 1, 5, 1, 1)]))
    feed.add(frame(spark, [(1, 0, 6, 1, 1)]))
    last = {}
    jobs.run_available(
        timewindows.tumbling_sum(feed.stream(), time=None, size="1 day"), "now", mode="update",
        each_batch=lambda b, n: last.update({(r["sensor_id"], r["windowEnd"]): r["total"] for r in b.collect()}))
    assert sum(last.values()) == 15


def by_batch(feed, keys, **windows):
    """The windows that each micro-batch gives out, and the rows that its operators put into state."""
    given, rows = {}, []
    stats = timewindows.sliding_stats(feed.stream().withWatermark("event_time", "3 seconds"), keys, "sensor_6", **windows)
    query = jobs.start_job(stats, "by-batch", every=None, each_batch=lambda b, n: given.update({n: sorted(
        map(repr, b.collect()))}))
    query.awaitTermination()
    return given, sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"])


@pytest.mark.parametrize("keys, size, slide", [
    (["sensor_id"], "30 seconds", "1 second"), (["place", "sensor_id"], "10 seconds", "2 seconds")])
def test_open_windows_close_when_windowed_aggregates_do(spark, folder, monkeypatch, keys, size, slide):
    feed, r, newest = Feed(spark, folder, "sensor_id bigint, place string, event_time timestamp, sensor_6 int"), random.Random(3), 0
    late = [0, 0, 2_999_000, 3_000_000, 40_000_000]
    # The last steps bring the watermark to a millisecond before the end of a window, and to that end.
    for steps in ([r.randint(0, 900_000) for _ in range(60)], [400_000_000, *[0] * 9], [700_000] * 30, [600_999_000], [603_999_000], [604_000_000]):
        rows = []
        for step in steps:
            newest = newest + step if step < 600_000_000 else step
            us = max(-5_000_000, newest - r.choice(late)) if len(steps) > 1 else newest
            rows.append((r.choice([None, 1, 2, (1 << 53) + 1]), r.choice([None, "a", "b"]), us,
                         r.choice([None, 2147483647, *range(60, 80)])))
        df = spark.createDataFrame(rows, "sensor_id bigint, place string, us bigint, sensor_6 int")
        feed.add(df.select("sensor_id", "place", F.timestamp_micros("us").alias("event_time"), "sensor_6"))
    got, _ = by_batch(feed, keys, size=size, slide=slide)
    with monkeypatch.context() as m:
        m.setattr(timewindows.sliding, "fits", lambda *a: False)
        want, _ = by_batch(feed, keys, size=size, slide=slide)
    assert got == want and sum(map(len, got.values())) > 200


def test_state_of_a_stream_has_no_row_for_each_window(spark, folder):
    feed = Feed(spark, folder, "sensor_id bigint, event_time timestamp, sensor_6 int")
    for n in (0, 1):
        feed.add(spark.range(400).select("id", F.timestamp_micros((F.col("id") + 400 * n) * 100_000_000), F.lit(7)).toDF(
            "sensor_id", "event_time", "sensor_6"))
    given, put = by_batch(feed, ["sensor_id"])
    assert sum(map(len, given.values())) > 23_000 and put < 2_000


def test_stream_takes_a_time_that_pandas_has_not(spark, folder):
    feed, years = Feed(spark, folder, "sensor_id int, event_time timestamp, sensor_6 int"), 3_000 * 31_557_600 * 1_000_000
    for us in (5_000_000, years, 6_000_000):
        feed.add(frame(spark, [(1, us, 1, 1, 7)]).select("sensor_id", "event_time", "sensor_6"))
    given, _ = by_batch(feed, ["sensor_id"])
    assert sum(map(len, given.values())) == 31  # of both cells in time; the other one stays open


def test_runs_are_the_same_in_small_pieces(monkeypatch):
    from flowgauge.streaming import sliding

    r = random.Random(4)
    rows = [(1, r.randint(0, 3_000), r.randint(1, 100)) for _ in range(2_000)]
    cells = pd.DataFrame(rows, columns=["_key0", "_cell", "_value"]).assign(_null0=False, _float=0.0, _has=True, _above=False)
    cells = pd.concat([cells.assign(_block=b) for b in (0, 1, 2, 3, 4, 5)])
    inside = [(c // 600 <= 5) and (c + 1) // 600 <= b <= (c + 30) // 600 for c, b in zip(cells["_cell"], cells["_block"])]
    cells = sliding._cells(cells[inside], ["_key0", "_null0"])
    whole = pd.concat(sliding._runs(cells, ["_key0", "_null0"], 30, 600, None, 2_500))
    monkeypatch.setattr(sliding, "PIECE_CELLS", 7)
    pieces = pd.concat(sliding._runs(cells, ["_key0", "_null0"], 30, 600, None, 2_500))
    assert whole.reset_index(drop=True).equals(pieces.reset_index(drop=True))
    ends = [e for f, t in zip(whole["_first"], whole["_last"]) for e in range(f, t + 1)]
    assert sorted(ends) == sorted({c + i for _, c, _ in rows for i in range(1, 31) if c + i <= 2_500})
