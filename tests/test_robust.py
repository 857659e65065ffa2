"""Retries, late rows, state clean-up, hot keys, interleaved snapshots, job history and exact metrics."""

import random

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import changes, joins, model
from flowgauge.streaming import hotkeys, jobs, keyed, late, sinks
from tests.streams import Feed

ROWS = "k string, t bigint, v int"


# --- failed writes ------------------------------------------------------------

class Flaky:
    """A sink by batch id that fails a given number of times for some batches, half way through."""

    def __init__(self, failures):
        self.failures, self.stored, self.calls = dict(failures), {}, []

    def __call__(self, batch, n):
        rows = sorted(map(tuple, batch.collect()))
        self.calls.append(n)
        self.stored[n] = rows[:1]
        if self.failures.get(n, 0):
            self.failures[n] -= 1
            raise OSError("no answer")
        self.stored[n] = rows

    def rows(self):
        return sorted(r for part in self.stored.values() for r in part)


def batches(spark, n):
    return [spark.createDataFrame([(f"k{i}", i, j) for j in range(3)], ROWS) for i in range(n)]


def test_a_sink_that_fails_twice_loses_and_doubles_nothing(spark, folder):
    flaky = Flaky({1: 2})
    sink = sinks.retrying(flaky, folder, attempts=3, wait_s=lambda a: 0.0)
    for n, batch in enumerate(batches(spark, 5)):
        sink(batch, n)
    assert flaky.rows() == sorted(tuple(r) for b in batches(spark, 5) for r in b.collect())
    assert flaky.calls == [0, 1, 1, 2, 1, 3, 4]
    assert sinks.waiting_batches(spark, folder) == [] and sinks.dead_letters(spark, folder) is None


def test_what_fails_for_good_becomes_a_dead_letter_with_its_rows(spark, folder):
    flaky = Flaky({0: 99})
    sink = sinks.retrying(flaky, folder, attempts=3, wait_s=lambda a: 0.0)
    for n, batch in enumerate(batches(spark, 5)):
        sink(batch, n)
    assert flaky.calls.count(0) == 3
    dead = sinks.dead_letters(spark, folder).collect()
    assert sorted((r["k"], r["v"], r["batch_id"], r["error"]) for r in dead) == [("k0", j, 0, "no answer") for j in range(3)]


def test_retries_wait_for_their_time_and_repeated_batches_are_harmless(spark, folder):
    clock = [0.0]
    flaky = Flaky({0: 1})
    sink = sinks.retrying(flaky, folder, wait_s=lambda a: 10.0, now=lambda: clock[0])
    parts = batches(spark, 3)
    sink(parts[0], 0)
    clock[0] = 9.0
    sink(parts[1], 1)
    assert flaky.calls == [0, 1] and sinks.waiting_batches(spark, folder) == [0]
    clock[0] = 10.0
    for _ in range(2):
        sink(parts[2], 2)
    assert flaky.calls == [0, 1, 0, 2, 2] and sinks.waiting_batches(spark, folder) == []
    assert flaky.rows() == sorted(tuple(r) for b in parts for r in b.collect())


def test_a_late_retry_of_an_upsert_does_not_undo_a_newer_batch(spark, folder):
    store = keyed.upsert(f"{folder}/table", ["k"], ["t"], buckets=2)
    failed = []

    def sink(batch, n):
        if n == 0 and not failed:
            failed.append(n)
            raise OSError("no answer")
        store(batch, n)

    retry = sinks.retrying(sink, folder, wait_s=lambda a: 0.0)
    for n in range(3):
        retry(spark.createDataFrame([("a", n, n), (f"b{n}", n, n)], ROWS), n)
    got = {r["k"]: r["v"] for r in keyed.read_keyed(spark, f"{folder}/table", ["k"]).collect()}
    assert got == {"a": 2, "b0": 0, "b1": 1, "b2": 2}


# --- late rows ------------------------------------------------------------------

TIMED = "id bigint, s double"


def seconds(spark, rows):
    return spark.createDataFrame(rows, TIMED).select(
        "id", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("event_time"))


def test_late_rows_are_those_that_the_aggregate_drops(spark, folder):
    r = random.Random(5)
    feed = Feed(spark, folder + "-in", seconds(spark, []).schema)
    rows = []
    for n in range(6):
        part = [(100 * n + i, max(0.0, 40.0 * n + r.uniform(-160, 20))) for i in range(40)]
        rows += part
        feed.add(seconds(spark, part))
    jobs.run_available(feed.stream(), "late", each_batch=late.late_sink(
        folder, sinks.file_batch(f"{folder}/on"), sinks.file_batch(f"{folder}/late"), "10 seconds"))
    on, behind = (spark.read.parquet(f"{folder}/{p}") for p in ("on", "late"))
    assert on.count() + behind.count() == len(rows) and behind.count() > 10
    counted = feed.stream().withWatermark("event_time", "3 seconds").groupBy(F.window("event_time", "10 seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"))
    jobs.run_available(counted, "counted", path=folder + "-windows")
    got = {(x["start"], x["n"]) for x in spark.read.parquet(folder + "-windows").select("w.start", "n").collect()}
    want = {(x["start"], x["n"]) for x in on.groupBy(F.window("event_time", "10 seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n")).select("w.start", "n").collect()}
    assert got <= want and len(got) >= len(want) - 4  # the last windows are still open


def test_rows_without_a_time_are_on_time_and_repeated_batches_agree(spark, folder):
    on, behind = [], []
    sink = late.late_sink(folder, lambda d, n: on.append((n, sorted(r["id"] for r in d.collect()))),
                          lambda d, n: behind.append((n, sorted(r["id"] for r in d.collect()))), "10 seconds")
    for n, part in enumerate([[(1, 1000.0)], [(2, 5.0), (3, None)], [(4, 5.0), (5, None), (6, 1001.0)]]):
        for _ in range(2):
            sink(seconds(spark, part), n)
    assert on == [(0, [1])] * 2 + [(1, [2, 3])] * 2 + [(2, [5, 6])] * 2
    assert behind == [(0, [])] * 2 + [(1, [])] * 2 + [(2, [4])] * 2


# --- state ---------------------------------------------------------------------

def payments(spark, rows):
    return spark.createDataFrame(rows, "s bigint, account_id string, transaction_id string, lat double").select(
        (F.col("s") * 1000).alias("ts"), "account_id", "transaction_id", F.lit(1).alias("amount"), "lat", F.lit(0.0).alias("lon"),
        F.timestamp_seconds("s").alias("event_time"))


def people(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "acc_id string").select(
        "acc_id", *[F.lit("x").alias(c) for c in ("f_name", "l_name", "email", "gender", "phone", "card")])


def pairs(df):
    return sorted((r["txn1_id"], r["txn2_id"]) for r in df.collect())


def test_join_state_stays_below_two_intervals_of_input(spark, folder):
    feed = Feed(spark, folder + "-in", payments(spark, []).schema)
    checkpoint, held = folder + "-checkpoint", []
    for n in range(10):  # a payment a minute, twenty a batch: an interval is ten rows
        feed.add(payments(spark, [(60 * (20 * n + i), "1", f"t{20 * n + i}", 0.0) for i in range(20)]))
        found = joins.frauds(feed.stream(), people(spark, ["1"]))
        jobs.run_available(found, "state", path=folder + "-out", checkpoint=checkpoint)
        held.append([jobs.state_rows(spark, checkpoint, side).count() for side in ("left", "right")])
    assert all(left <= 21 and right <= 11 for left, right in held[1:]), held


# --- hot keys -------------------------------------------------------------------

def test_sketches_merge_and_name_the_hot_key(spark, folder):
    r = random.Random(2)
    rows = [(i, "hot" if r.random() < 0.6 else f"k{r.randrange(5000)}", str(i), 0.0) for i in range(6000)]
    sink = hotkeys.sketch_sink(folder, ["account_id"])
    for n in range(4):
        sink(payments(spark, rows[n::4]).repartition(3), n)
        sink(payments(spark, rows[n::4]), n)                  # a repeated batch replaces itself
    found, newest = hotkeys.hot_keys(spark, folder, 0.05)
    assert [k for k, _ in found] == ["hot"] and abs(found[0][1] - 0.6) < 0.03 and newest == 5999 * 10**6
    assert hotkeys.hot_keys(spark, folder, 0.05, last=1)[0][0][0] == "hot"
    plan = hotkeys.next_salts(spark, folder, tasks=10)
    assert plan[0] == hotkeys.NO_SALTS[0] and plan[1].from_us == (5999 + 1200) * 10**6
    assert dict(plan[1].by_key)["hot"] in (12, 13)
    assert hotkeys.next_salts(spark, folder, tasks=10, earlier=plan) == plan[1:]


def test_salts_that_change_keep_every_pair_once(spark):
    r = random.Random(4)
    rows = [(r.randrange(6000), r.choice("aab"), str(i), r.choice([0.0, 1.0])) for i in range(400)]
    plan = [hotkeys.NO_SALTS[0], hotkeys.Salts(2000 * 10**6, (("a", 3),)), hotkeys.Salts(3500 * 10**6, (("a", 7), ("b", 2)))]
    plain = joins.frauds(payments(spark, rows), people(spark, "ab"))
    salted = joins.frauds(payments(spark, rows), people(spark, "ab"), salts=plan)
    assert pairs(salted) == pairs(plain) != []


def test_a_hot_account_is_spread_over_the_tasks_of_a_stream_and_equals_the_batch(spark, folder):
    r = random.Random(6)
    rows = sorted((r.randrange(40_000), "hot" if r.random() < 0.6 else f"k{r.randrange(400)}", str(i), r.choice([0.0, 1.0]))
                  for i in range(1500))
    feed = Feed(spark, folder + "-in", payments(spark, []).schema)
    checkpoint, sketch, plan = folder + "-checkpoint", folder + "-sketch", hotkeys.NO_SALTS
    customers = people(spark, ["hot"] + [f"k{i}" for i in range(400)])
    for n, part in enumerate([[x for x in rows if x[0] < 10_000], [x for x in rows if x[0] >= 10_000]]):
        feed.add(payments(spark, part))
        found = joins.frauds(feed.stream(), customers, salts=plan)
        jobs.run_available(found, "hot", path=folder + "-out", checkpoint=checkpoint)
        hotkeys.sketch_sink(sketch, ["account_id"])(payments(spark, part), n)
        plan = hotkeys.next_salts(spark, sketch, tasks=16, earlier=plan)
    assert pairs(spark.read.schema(found.schema).parquet(folder + "-out")) == pairs(joins.frauds(feed.batch(), customers)) != []
    # Rows of the second side by task, as the join deals them once the salts hold.
    late_rows = payments(spark, [x for x in rows if x[0] >= 15_000])
    salt = hotkeys.second_salt(plan, ["account_id"], F.col("event_time"), F.col("transaction_id"))
    share = lambda *by: [x["count"] for x in late_rows.withColumn("salt", salt).repartition(16, *by).groupBy(
        F.spark_partition_id()).count().orderBy("count").collect()]
    salted, plain = share("account_id", "salt"), share("account_id")
    assert max(salted) <= 3 * salted[len(salted) // 2] and max(plain) > 6 * plain[len(plain) // 2]


def test_a_hot_account_not_known_yet_meets_only_the_rows_near_it(spark, folder):
    r = random.Random(8)
    rows = sorted((r.randrange(12_000), "hot", str(i), r.choice([0.0, 1.0])) for i in range(600))  # twenty intervals, one batch
    feed = Feed(spark, folder + "-in", payments(spark, []).schema).add(payments(spark, rows))
    for name, salts in (("unknown", hotkeys.NO_SALTS), ("salted", 2)):
        found = joins.frauds(feed.stream(), people(spark, ["hot"]), salts=salts)
        jobs.run_available(found, name, path=f"{folder}-out-{name}", checkpoint=f"{folder}-{name}")
        assert pairs(spark.read.schema(found.schema).parquet(f"{folder}-out-{name}")) == pairs(
            joins.frauds(feed.batch(), people(spark, ["hot"]))) != []
        for side in ("left", "right"):  # rows under one key of the state: a row of the other side is held against them all
            held = jobs.state_rows(spark, f"{folder}-{name}", side, batch_id=0)
            assert max(x["count"] for x in held.groupBy(F.to_json("key")).count().collect()) < 120


def test_salts_are_dealt_to_a_grid_and_the_state_keeps_few_copies(spark, folder):
    r = random.Random(10)
    rows = sorted((r.randrange(12_000), "hot", str(i), r.choice([0.0, 1.0])) for i in range(400))
    feed = Feed(spark, folder + "-in", payments(spark, []).schema).add(payments(spark, rows))
    expected = pairs(joins.frauds(feed.batch(), people(spark, ["hot"])))
    ten = [hotkeys.Salts(-(1 << 62), (("hot", 10),))]
    for name, salts, most in (("none", hotkeys.NO_SALTS, 2.7), ("number", 4, 5.2), ("plan", ten, 9.3)):
        found = joins.frauds(feed.stream(), people(spark, ["hot"]), salts=salts)
        jobs.run_available(found, name, path=f"{folder}-out-{name}", checkpoint=f"{folder}-{name}")
        assert pairs(spark.read.schema(found.schema).parquet(f"{folder}-out-{name}")) == expected != []
        held = [jobs.state_rows(spark, f"{folder}-{name}", side, batch_id=0).count() for side in ("left", "right")]
        assert sum(held) < most * len(rows), held  # 3, 9 and 21 copies of a row where first rows alone are salted


def test_pairs_of_a_hot_account_are_not_sent_to_its_customer(spark, folder):
    feed = Feed(spark, folder + "-in", payments(spark, []).schema).add(payments(spark, [(100, "1", "a", 0.0), (101, "1", "b", 1.0)]))
    found = joins.frauds(feed.stream(), people(spark, ["1"]), salts=hotkeys.NO_SALTS)
    jobs.run_available(found, "sent", path=folder + "-out", checkpoint=folder + "-checkpoint")
    assert pairs(spark.read.schema(found.schema).parquet(folder + "-out")) == [("a", "b")]
    # The customer is found in the state, so it was joined to payments.
    assert "email" in jobs.state_rows(spark, folder + "-checkpoint", "right", batch_id=0).schema["value"].dataType.simpleString()


# --- snapshots under way ----------------------------------------------------------

def test_interleaved_snapshot_gives_the_final_state_wherever_its_chunks_were_read(spark):
    row = "struct<id:bigint,name:string>"
    for seed in range(3):
        r = random.Random(seed)
        state, log, states = {}, [], [{}]
        for seq in range(1, 200):
            i = r.randrange(12)
            if i in state and r.random() < 0.3:
                log.append(("d", (i, state.pop(i)), None, seq))
            else:
                name = f"v{seq}"
                log.append(("u" if i in state else "c", (i, state[i]) if i in state else None, (i, name), seq))
                state[i] = name
            states.append(dict(state))
        chunks, start = [], 40
        for c in range(3):
            low, high = start + 40 * c, start + 40 * c + 30
            at = r.randint(low, high)
            chunks += [(i, n, low, high) for i, n in states[at].items() if i % 3 == c]
        events = spark.createDataFrame(log, f"op string, before {row}, after {row}, seq bigint").filter(F.col("seq") > start)
        read = spark.createDataFrame(chunks, "id bigint, name string, low bigint, high bigint")
        whole = changes.interleaved_snapshot(read, events, ["id"])
        got = {x["id"]: x["name"] for x in changes.apply_changes(whole, ["id"], ["seq", "part"]).collect()}
        assert got == state
        # In the order of the log too, without an upsert that knows older from newer.
        seen = {}
        for e in whole.orderBy("seq", "part").collect():
            if e["op"] == "d":
                seen.pop(e["before"]["id"], None)
            else:
                seen[e["after"]["id"]] = e["after"]["name"]
        assert seen == state


# --- jobs -------------------------------------------------------------------------

def test_cadence_and_states_of_jobs(spark, folder):
    listener = jobs.JobHistory(spark, folder)
    spark.streams.addListener(listener)
    try:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 20).load()
        job = jobs.start_job(ticks, "ticking", path=folder + "-out", every="5 seconds")
        while not job.lastProgress or job.lastProgress["batchId"] < 3:
            job.awaitTermination(0.2)
        job.stop()

        def broken(batch, n):
            raise ValueError("broken on purpose")

        with pytest.raises(Exception, match="broken on purpose"):
            jobs.run_available(ticks, "broken", each_batch=broken)
        assert listener.wait_for(["ticking", "broken"])
    finally:
        spark.streams.removeListener(listener)
    rows = jobs.history(spark, folder).persist()
    states = {r["job"]: (r["state"], r["runs"]) for r in jobs.job_states(rows).collect()}
    assert states == {"ticking": ("stopped", 1), "broken": ("failed", 1)}
    assert "broken on purpose" in rows.filter("job = 'broken' AND event = 'failed'").first()["error"]
    seconds_ = [r["seconds"] for r in jobs.cadence(rows).filter("batch_id > 1").collect()]
    assert seconds_ and all(4.5 < s < 5.5 for s in seconds_), seconds_
    assert rows.filter("event = 'batch'").agg(F.sum("rows")).first()[0] == spark.read.parquet(folder + "-out").count()


# --- model figures -----------------------------------------------------------------

@pytest.mark.parametrize("cells", [1, 7, 256])
def test_exact_metrics_equal_pair_counting(spark, cells):
    r = random.Random(cells)
    rows = [(r.choice([0, 0, 1]), float(r.randint(0, 30))) for _ in range(400)] + [(1, 5.5), (0, None)]
    got = model.ranked_metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s", cells).first()
    known = [x for x in rows if x[1] is not None]
    p, n = [s for y, s in known if y], [s for y, s in known if not y]
    auroc = sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))
    ap, found = 0.0, 0
    for t in sorted({s for _, s in known}, reverse=True):
        tp = sum(s >= t for s in p)
        ap += (tp - found) / len(p) * tp / (tp + sum(s >= t for s in n))
        found = tp
    assert got["auroc"] == pytest.approx(auroc) and got["ap"] == pytest.approx(ap)


def test_metrics_of_one_class_or_no_rows_are_null(spark):
    for rows in ([(1, 0.5), (1, 0.7)], [(0, 0.5)], []):
        got = model.ranked_metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
        assert got["auroc"] is None and got["ap"] is None


def test_split_by_key_does_not_depend_on_the_partitioning(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    a, b = model.split_by_key(rows, ["k"], 0.7, 3)
    again, _ = model.split_by_key(rows.repartition(7).orderBy(F.rand()), ["k"], 0.7, 3)
    assert a.intersect(b).count() == 0 and a.count() + b.count() == 20_000
    assert a.exceptAll(again).count() == 0 and 0.69 < a.count() / 20_000 < 0.71
    other, _ = model.split_by_key(rows, ["k"], 0.7, 4)
    assert 8_000 < a.intersect(other).count() < 12_000
