"""Ordered operators against brute force, with and without hot keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import ordered

SCHEMA = "k string, t bigint, id bigint, v bigint"


def rows(seed, n=400):
    r = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    # Many equal times, bursts, and a few rows far away.
    times = [r.choice([r.randint(0, 50), r.randint(0, 10**6), 777]) for _ in range(n)]
    return [(r.choice(keys), t, i, r.randint(-5, 20)) for i, t in enumerate(times)]


def by_key(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return {k: sorted(g, key=lambda x: (x[1], x[2])) for k, g in groups.items()}


@pytest.mark.parametrize("hot_rows", [3, 20, 100, 10**6])
@pytest.mark.parametrize("seed", [1, 2])
def test_position_and_running_sum(spark, seed, hot_rows):
    data = rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = ordered.position(df, ["k"], ["t", "id"], hot_rows=hot_rows)
    assert sorted(got.columns) == ["id", "k", "position", "t", "v"]
    expected = {r[2]: i + 1 for g in by_key(data).values() for i, r in enumerate(g)}
    assert {r["id"]: r["position"] for r in got.collect()} == expected

    got = ordered.running_sum(df, ["k"], ["t", "id"], "v", hot_rows=hot_rows)
    sums = {}
    for g in by_key(data).values():
        total = 0
        for r in g:
            total += r[3]
            sums[r[2]] = total
    assert {r["id"]: r["running_sum"] for r in got.collect()} == sums


@pytest.mark.parametrize("hot_rows, size", [(5, 3), (10**6, 3), (10**6, 20)])
def test_count_windows(spark, hot_rows, size):
    data = rows(3)
    got = ordered.count_windows(spark.createDataFrame(data, SCHEMA), ["k"], ["t", "id"], "v", size, ["id"], hot_rows)
    expected = set()
    for k, g in by_key(data).items():
        for w in range(len(g) // size):
            part = g[size * w: size * w + size]
            best = max(part, key=lambda r: r[3])  # the first on ties
            expected.add((k, w, sum(r[3] for r in part), best[3], best[2]))
    assert {tuple(r) for r in got.collect()} == expected


@pytest.mark.parametrize("n, windows", [(2, 0), (3, 1), (4, 1), (5, 1), (6, 2)])
def test_incomplete_count_window_is_left_out(spark, n, windows):
    df = spark.createDataFrame([("a", i, i, i) for i in range(n)], SCHEMA)
    assert ordered.count_windows(df, ["k"], ["t", "id"], "v").count() == windows


def test_hot_key_is_cut_into_cells(spark):
    df = spark.createDataFrame([("hot", i, i, 1) for i in range(1000)] + [("a", i, i, 1) for i in range(5)], SCHEMA)
    cells = ordered.with_cells(df, ["k"], ["t", "id"], hot_rows=100).groupBy("k", "_cell").count().collect()
    hot = [r["count"] for r in cells if r["k"] == "hot"]
    assert len(hot) > 50 and max(hot) <= 20
    assert [r["count"] for r in cells if r["k"] == "a"] == [5]


def test_burst_and_equal_times_of_a_hot_key_are_cut_too(spark):
    burst = [("hot", 1_000_000 + i, i, 1) for i in range(1000)]
    equal = [("hot", 5_000_000, 1000 + i, 1) for i in range(1000)]
    df = spark.createDataFrame([("hot", 0, -1, 1), *burst, *equal, ("hot", 10**9, 5000, 1)], SCHEMA)
    cells = ordered.with_cells(df, ["k"], ["t", "id"], hot_rows=100).groupBy("_cell").count()
    assert cells.agg({"count": "max"}).first()[0] <= 100
    got = ordered.position(df, ["k"], ["t", "id"], hot_rows=100).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 2003))
    assert [(r["t"], r["id"]) for r in got] == sorted((r["t"], r["id"]) for r in got)


def test_null_time_sorts_first(spark):
    data = [("a", None, 1, 5), ("a", 3, 2, 1), ("a", 9, 3, 1), ("a", 4, 4, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["id"]: r["position"] for r in ordered.position(df, ["k"], ["t", "id"], hot_rows=1).collect()}
    assert got == {1: 1, 2: 2, 4: 3, 3: 4}


def test_null_values_count_as_nothing_in_the_sum(spark):
    df = spark.createDataFrame([("a", 1, 1, None), ("a", 2, 2, 4)], SCHEMA)
    got = {r["id"]: r["running_sum"] for r in ordered.running_sum(df, ["k"], ["t", "id"], "v").collect()}
    assert got == {1: 0, 2: 4}


@pytest.mark.parametrize("per_key", [False, True])
@pytest.mark.parametrize("chunk", [2, 4096])
def test_inactivity_gaps(spark, per_key, chunk):
    r = random.Random(5)
    data, t = [], 0
    for i in range(300):
        t += r.choice([1, 10, 44_999_999, 45_000_000, 45_000_001, 200_000_000])
        data.append((r.choice("abc"), t, i, 0))
    df = spark.createDataFrame(data, SCHEMA).withColumn("event_time", F.timestamp_micros("t"))
    got = ordered.inactivity_gaps(df, ["k"] if per_key else [], cells_per_chunk=chunk)
    groups = by_key(data) if per_key else {None: data}
    expected = sorted((b[1] - a[1], (b[1] - a[1]) // 45_000_000) for g in groups.values()
                      for a, b in zip(g, g[1:]) if b[1] - a[1] > 45_000_000)
    assert sorted((x["gap_us"], x["alerts"]) for x in got.collect()) == expected


def test_latest_per_key_takes_the_tie_break(spark):
    df = spark.createDataFrame([("a", 5, 1, 10), ("a", 5, 2, 20), ("a", 4, 3, 30), (None, 1, 4, 40)], SCHEMA)
    got = {r["k"]: r["v"] for r in ordered.latest_per_key(df, ["k"], ["t", "id"]).collect()}
    assert got == {"a": 20, None: 40}


def test_open_gap(spark):
    df = spark.createDataFrame([("a", 0, 1, 0), ("b", 10_000_000, 2, 0)], SCHEMA).withColumn(
        "event_time", F.timestamp_micros("t"))
    as_of = F.timestamp_micros(F.lit(46_000_000))
    assert [r["k"] for r in ordered.open_gap(df, as_of, ["k"]).collect()] == ["a"]


@pytest.mark.parametrize("prefix", ["", "payment-2024-", "é"])
def test_text_ids_of_one_time_are_cut(spark, prefix):
    rows = [("hot", 7, f"{prefix}{i:05d}{'x' * (i % 3)}", 1) for i in range(1000)] + [("hot", 7, None, 1), ("hot", 7, prefix, 1)]
    df = spark.createDataFrame(rows, "k string, t bigint, id string, v bigint")
    cells = ordered.with_cells(df, ["k"], ["t", "id"], hot_rows=100).groupBy("_cell").count()
    assert cells.agg({"count": "max"}).first()[0] <= 100
    got = ordered.position(df, ["k"], ["t", "id"], hot_rows=100).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 1003))
    assert [r["id"] for r in got] == sorted((r[2] for r in rows), key=lambda x: (x is not None, (x or "").encode()))


def test_deep_bursts_are_cut_until_none_is_left(spark):
    times = [10**9 * k for k in range(3)] + [10**15 + 10**5 * k for k in range(3)] + list(range(400)) + [10**18]
    df = spark.createDataFrame([("hot", t, i, 1) for i, t in enumerate(times)], SCHEMA)
    cells = ordered.with_cells(df, ["k"], ["t", "id"], hot_rows=40).groupBy("_cell").count()
    assert cells.agg({"count": "max"}).first()[0] <= 40


def test_equal_rows_of_a_hot_key_end_the_cutting(spark):
    df = spark.createDataFrame([("hot", 1, 1, 1)] * 300, SCHEMA)
    assert ordered.position(df, ["k"], ["t", "id"], hot_rows=100).count() == 300
