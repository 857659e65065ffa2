import glob
import random

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import changes, views as view_ops
from flowgauge.plans import pipelines
from flowgauge.streaming import jobs, keyed, views
from tests.streams import Feed

SCHEMA = "k string, t bigint, v int"


def write(spark, path, n, rows, order=("t",)):
    keyed.write_changes(spark.createDataFrame(rows, SCHEMA), path, n, ["k"], list(order), buckets=4)


def state(spark, path, order=("batch_id",)):
    return {r["k"]: r["v"] for r in keyed.read_keyed(spark, path, ["k"], list(order)).collect()}


def test_last_write_wins(spark, folder):
    assert keyed.read_keyed(spark, folder, ["k"]) is None
    write(spark, folder, 0, [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)])
    write(spark, folder, 1, [("a", 1, 9)])
    assert state(spark, folder) == {"a": 9, "b": 3}                    # by arrival
    assert state(spark, folder, ["t"]) == {"a": 2, "b": 3}             # by the row's own time


def test_repeated_batch_replaces_itself(spark, folder):
    for _ in range(2):
        write(spark, folder, 0, [("a", 1, 1)])
        write(spark, folder, 1, [("a", 2, 2), ("c", 2, 5)])
    assert state(spark, folder) == {"a": 2, "c": 5}
    assert spark.read.parquet(f"{folder}/rows").count() == 3


@pytest.mark.parametrize("order", [["batch_id"], ["t"]])
def test_compaction_changes_nothing(spark, folder, order):
    write(spark, folder, 0, [("a", 5, 1), ("b", 5, 2)])
    write(spark, folder, 1, [("a", 6, 3)])
    keyed.compact(spark, folder, ["k"], order, upto=1)
    write(spark, folder, 2, [("b", 4, 7), ("c", 1, 8)])
    expected = {"a": 3, "b": 7 if order == ["batch_id"] else 2, "c": 8}
    for upto in (None, 2, 2, None):
        assert state(spark, folder, order) == expected
        keyed.compact(spark, folder, ["k"], order, upto=upto)
    assert state(spark, folder, order) == expected


def test_compaction_keeps_what_a_repeated_batch_needs(spark, folder):
    for n in range(7):
        write(spark, folder, n, [("a", n, n), (f"k{n}", n, n)])
        if n in (1, 3, 5):
            keyed.compact(spark, folder, ["k"])
    before = lambda n: {r["k"]: r["v"] for r in keyed.read_keyed(spark, folder, ["k"], before=n).collect()}
    assert before(5) == {"a": 4, "k0": 0, "k1": 1, "k2": 2, "k3": 3, "k4": 4}
    assert before(6)["a"] == 5
    assert state(spark, folder)["a"] == 6 and len(state(spark, folder)) == 8
    bucket = keyed.touched(spark.createDataFrame([("a", 1, 1)], SCHEMA), ["k"], 4)[0]
    versions = lambda: sorted(p["version"] for p in keyed.parts(spark, folder) if p["bucket"] == bucket)
    # Batches 0 to 4 are folded into version 9; the parts stay for readers under way, batches 5 and 6 are whole.
    assert versions()[-3:] == [9, 10, 12] and 8 in versions()
    keyed.compact(spark, folder, ["k"])
    assert versions() == [9, 10, 11, 12]


def test_upsert_of_one_key_writes_one_bucket_and_compaction_only_full_ones(spark, folder):
    write(spark, folder, 0, [(f"k{i}", i, i) for i in range(100)])
    before = set(glob.glob(f"{folder}/rows/*/*/*/*.parquet"))
    assert len(before) == 4
    for n in (1, 2, 3):
        write(spark, folder, n, [("k7", n, n)])
    added = set(glob.glob(f"{folder}/rows/*/*/*/*.parquet")) - before
    bucket, = keyed.touched(spark.createDataFrame([("k7", 1, 1)], SCHEMA), ["k"], 4)
    assert len(added) == 3 and all(f"/bucket={bucket}/" in f for f in added)
    assert keyed.compact(spark, folder, ["k"]) == [bucket]
    assert {f for f in glob.glob(f"{folder}/rows/*/*/*/*.parquet") if "version=5" in f} == {
        f for f in glob.glob(f"{folder}/rows/bucket={bucket}/version=5/*/*.parquet")} != set()
    assert state(spark, folder)["k7"] == 3


def test_fold_and_join_read_the_table_without_a_shuffle(spark, folder):
    write(spark, folder, 0, [(f"k{i}", i, i) for i in range(100)])
    write(spark, folder, 1, [("k7", 1, 1)])
    table = keyed.read_keyed(spark, folder, ["k"])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(table) and "Bucketed: true" in plan(table)
    batch = spark.createDataFrame([("k7", 9)], "k string, z int")
    joined = plan(table.hint("merge").join(batch, "k"))
    assert joined.count("Exchange") == 1 and "Join" in joined
    assert table.join(batch, "k").count() == 1


def test_only_the_buckets_of_a_batch_are_read(spark, folder):
    write(spark, folder, 0, [(f"k{i}", i, i) for i in range(100)])
    batch = spark.createDataFrame([("k7", 1, 1)], SCHEMA)
    known = keyed.read_keyed(spark, folder, ["k"], only=keyed.touched(batch, ["k"], 4))
    assert 0 < known.count() < 60
    files = known.inputFiles()
    bucket, = keyed.touched(batch, ["k"], 4)
    assert len(files) == 1 and f"bucket={bucket}" in files[0]


def test_table_opens_again_in_another_session(spark, folder):
    write(spark, folder, 0, [("a", 1, 1), ("b", 1, 2)])
    spark.sql(f"DROP TABLE {keyed._name(folder)}")
    assert state(spark, folder) == {"a": 1, "b": 2}
    spark.sql(f"DROP TABLE {keyed._name(folder)}")
    write(spark, folder, 1, [("a", 2, 3)])
    assert state(spark, folder) == {"a": 3, "b": 2}


def test_state_before_a_batch(spark, folder):
    write(spark, folder, 0, [("a", 1, 1)])
    write(spark, folder, 1, [("a", 2, 2)])
    got = keyed.read_keyed(spark, folder, ["k"], before=1)
    assert [r["v"] for r in got.collect()] == [1]


def test_empty_batch(spark, folder):
    write(spark, folder, 0, [])
    write(spark, folder, 1, [("a", 1, 1)])
    write(spark, folder, 2, [])
    assert state(spark, folder) == {"a": 1}


def event(spark, rows):
    return spark.createDataFrame(
        [(op, None if op == "c" else (i, n), None if op == "d" else (i, n), t, t) for op, i, n, t in rows],
        "op string, before struct<id:bigint,name:string>, after struct<id:bigint,name:string>, ts bigint, seq bigint")


def replica(spark, path):
    return {r["id"]: r["name"] for r in pipelines.read_replica(spark, path).collect()}


def test_update_arriving_after_its_delete_does_not_revive_the_row(spark, folder):
    sink = pipelines.replica_sink(folder)
    sink(event(spark, [("c", 1, "a", 1), ("c", 2, "x", 1)]), 0)
    sink(event(spark, [("d", 1, "b", 5)]), 1)
    keyed.compact(spark, folder, ["id"], ["ts", "seq"])
    sink(event(spark, [("u", 1, "late", 3)]), 2)
    assert replica(spark, folder) == {2: "x"}
    sink(event(spark, [("c", 1, "again", 9)]), 3)
    assert replica(spark, folder) == {1: "again", 2: "x"}


def test_deleted_keys_can_be_forgotten(spark, folder):
    sink = pipelines.replica_sink(folder)
    sink(event(spark, [("c", 1, "a", 1), ("d", 1, "a", 2), ("c", 2, "b", 1)]), 0)
    for _ in range(2):
        keyed.compact(spark, folder, ["id"], ["ts", "seq"], forget=F.col("_deleted") & (F.col("ts") < 10), least=1, upto=0)
    assert spark.read.parquet(f"{folder}/rows").count() == 1
    assert replica(spark, folder) == {2: "b"}


def test_replica_follows_the_published_script(spark, folder):
    """Snapshot 100; insert 101, update 100; insert 103, update 100, delete 101."""
    schema = event(spark, [("c", 0, "", 0)]).schema
    feed = Feed(spark, folder + "-in", schema)
    feed.add(event(spark, [("r", 100, "first", 1)]))
    feed.add(event(spark, [("c", 101, "b", 2), ("u", 100, "c", 3)]))
    feed.add(event(spark, [("c", 103, "d", 4), ("u", 100, "e", 5), ("d", 101, "b", 6)]))
    jobs.run_available(feed.stream(), "replica", each_batch=pipelines.replica_sink(folder))
    assert replica(spark, folder) == {100: "e", 103: "d"}


def test_view_keeps_non_null_values(spark, folder):
    schema = "k string, t bigint, a int, b int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    for ignore, expected in [(True, (1, 9)), (False, (None, 9))]:
        path = f"{folder}-{ignore}"
        sink = views.view_sink(path, ["k"], ["t"], ignore)
        sink(df([("x", 1, 1, 2)]), 0)
        sink(df([("x", 2, None, 9)]), 1)
        row = views.read_view(spark, path, ["k"], ["t"], ignore_nulls=ignore).first()
        assert (row["a"], row["b"], row["t"]) == (*expected, 2)


def test_view_retention_keeps_a_row_of_exactly_that_age(spark, folder):
    df = spark.createDataFrame([("a", 1_000), ("b", 1_001), ("c", 999)], "k string, s bigint").select(
        "k", F.timestamp_seconds("s").alias("t"))
    views.view_sink(folder, ["k"], ["t"])(df, 0)
    got = views.read_view(spark, folder, ["k"], ["t"], as_of=F.timestamp_seconds(F.lit(1300)))
    assert sorted(r["k"] for r in got.collect()) == ["a", "b"]


def timed(spark, rows):
    return spark.createDataFrame(rows, "k string, s bigint, a int").select("k", F.timestamp_seconds("s").alias("t"), "a")


def test_expired_slots_leave_storage_whole(spark, folder):
    sink = views.view_sink(folder, ["k"], ["t"])
    sink(timed(spark, [("a", 100, 1), ("b", 100, 2), ("c", 550, 3)]), 0)
    sink(timed(spark, [("a", 950, 4)]), 1)
    stored = lambda: sorted((r["k"], r["a"]) for r in spark.read.parquet(f"{folder}/rows").collect())
    assert len(stored()) == 4
    views.expire(spark, folder, ["k"], ["t"], 1_000_000_000)       # all before 700 s goes by slots of 300 s
    assert stored() == [("a", 4)]
    assert [r["a"] for r in views.read_view(spark, folder, ["k"], ["t"]).collect()] == [4]


def test_expired_keys_leave_a_view_that_ignores_nulls_and_old_values_of_live_keys_stay(spark, folder):
    read = lambda: sorted((r["k"], r["a"]) for r in views.read_view(spark, folder, ["k"], ["t"], ignore_nulls=True).collect())
    sink = views.view_sink(folder, ["k"], ["t"], True)
    expire = lambda s: views.expire(spark, folder, ["k"], ["t"], s * 1_000_000, ignore_nulls=True)
    for n, rows in enumerate([[("a", 100, 1), ("b", 100, 2)], [("a", 500, None)], [("a", 900, None), ("c", 900, 3)]]):
        sink(timed(spark, rows), n)
        expire(rows[0][1])
    assert read() == [("a", 1), ("c", 3)]
    sink(timed(spark, [("d", 1000, 4)]), 3)
    size = lambda: spark.read.parquet(f"{folder}/rows").count()
    before = size()
    for _ in range(2):
        expire(1000)
    assert read() == [("a", 1), ("c", 3), ("d", 4)] and size() == 3 < before


def test_folded_registers_equal_merged_ones_and_lie_in_one_slot(spark, folder):
    r = random.Random(12)
    when = lambda: r.choice([None, r.randrange(9)])
    rows = [(r.choice("abc"), t, None if t is None else 10.0 * t, None if t is None or r.random() < 0.5 else t % 3) for t in (when() for _ in range(60))]
    rows += [("d", None, 5.0, None), ("e", 86_400 * 1_000_000, None, 1), ("f", 1, None, None), (None, 2, 1.0, 7)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double, w int")
    fields = ["t", "v", "w"]
    folded = view_ops.fold_registers(df, ["k"], fields, ["t"])
    merged = view_ops.merge_registers(view_ops.registers(df, fields, ["t"]), ["k"], fields)
    assert folded.dtypes == merged.dtypes and sorted(map(str, folded.collect())) == sorted(map(str, merged.collect()))
    assert "SortAggregate" not in folded._jdf.queryExecution().toString()
    views.view_sink(folder, ["k"], ["t"], ignore_nulls=True)(df, 0)
    assert {p["slot"] for p in keyed.parts(spark, folder)} == {0}  # a folder a bucket, however far the keys lie apart
    assert views.read_view(spark, folder, ["k"], ["t"], ignore_nulls=True).count() == 7


def test_registers_fold_in_any_grouping(spark):
    import random

    r = random.Random(3)
    rows = [(r.choice("ab"), i, r.choice([None, i]), r.choice([None, -i])) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t bigint, x int, y int")
    fields = ["t", "x", "y"]
    made = view_ops.registers(df, fields, ["t"])
    merge = lambda d: view_ops.merge_registers(d, ["k"], fields)
    whole = sorted(map(tuple, view_ops.values_of(merge(made), ["k"], fields).collect()))
    parts = [merge(made.filter(F.pmod(F.hash("t"), F.lit(3)) == i)) for i in range(3)]
    nested = merge(merge(parts[0].unionByName(parts[2])).unionByName(parts[1]))
    assert sorted(map(tuple, view_ops.values_of(nested, ["k"], fields).collect())) == whole
    assert whole == sorted(map(tuple, view_ops.latest_state(df, ["k"], ["t"], True).collect()))


def test_view_requests(spark):
    assert view_ops.parse_request("above60withRange/{lowerTemp}/{upperTemp}", "above60withRange/1.5/2") == {
        "lowerTemp": 1.5, "upperTemp": 2.0}
    assert view_ops.parse_request("above60", "other") is None
    spark.createDataFrame([(1, 5, 50.0), (2, 0, 50.0), (3, 1, 99.0)],
                          "device_id int, sensorGreaterThan60 int, sensorAverage double").createOrReplaceTempView("v")
    ids = lambda url: sorted(r["device_id"] for r in view_ops.query_view(spark, "v", url).collect())
    assert ids("above60") == [1, 3]
    assert ids("above60withRange/50/60") == [1]
    with pytest.raises(KeyError):
        view_ops.query_view(spark, "v", "nothing")


def test_recreated_view_starts_empty(spark, folder):
    assert views.fresh_view(spark, folder, False) == folder
    assert views.read_view(spark, views.fresh_view(spark, folder, True), ["k"], ["t"]) is None


# --- change log -------------------------------------------------------------

def test_encoding_of_the_published_script(spark):
    rows = [("c", None, (200, "i"), 1), ("u", (200, "i"), (200, "u"), 2), ("d", (200, "u"), None, 3)]
    df = spark.createDataFrame(rows, "op string, before struct<id:int,name:string>, after struct<id:int,name:string>, seq int")
    log = changes.to_change_json(changes.encode(df, ["seq"]), ["id"]).orderBy("seq", "part").collect()
    assert [r["op"] for r in log] == ["c", "d", "c", "d"]
    assert {r["key"] for r in log} == {'{"id":200}'}
    assert log[1]["value"] == '{"before":{"id":200,"name":"i"},"after":null,"op":"d"}'
    assert log[2]["value"] == '{"before":null,"after":{"id":200,"name":"u"},"op":"c"}'


def test_decoding_accepts_all_kinds_and_sets_the_rest_aside(spark):
    lines = ['{"before":null,"after":{"id":1,"name":"a"},"op":"r","ts_ms":5}',
             '{"before":{"id":1,"name":"a"},"after":{"id":1,"name":"b"},"op":"u"}',
             '{"op":"z"}', 'not json']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = changes.decode(df, "id int, name string")
    assert [(r["op"], r["after"]["name"], r["ts_ms"]) for r in good.collect()] == [("r", "a", 5), ("u", "b", None)]
    assert {(r["decoded"], r["reason"]) for r in bad.collect()} == {
        ('{"op":"z"}', "unknown operation"), ("not json", "unreadable")}


def test_update_of_the_key_moves_the_row(spark, folder):
    row = "struct<id:bigint,name:string>"
    rows = [("c", None, (1, "a"), 1, 1), ("u", (1, "a"), (2, "b"), 2, 2), ("u", (2, "b"), (2, "c"), 3, 3)]
    events = spark.createDataFrame(rows, f"op string, before {row}, after {row}, ts bigint, seq bigint")
    assert [tuple(r) for r in changes.apply_changes(events, ["id"], ["ts", "seq"]).collect()] == [(2, "c")]
    sink = pipelines.replica_sink(folder, buckets=3)
    for n in range(3):
        sink(events.filter(f"seq = {n + 1}"), n)
        keyed.compact(spark, folder, ["id"], ["ts", "seq"])
    assert replica(spark, folder) == {2: "c"}


def test_upserts_without_order_are_refused(spark, folder):
    with pytest.raises(ValueError):
        keyed.write_changes(spark.createDataFrame([("a", 1, 1)], SCHEMA), folder, 0, ["k"])


def test_numbers_as_text_are_ordered_as_numbers(spark, folder):
    rows = spark.createDataFrame([("a", "999"), ("a", "1000")], "k string, transaction_id string")
    keyed.write_changes(rows, folder, 0, ["k"], by=pipelines.by_number("transaction_id"))
    assert keyed.read_keyed(spark, folder, ["k"]).first()["transaction_id"] == "1000"


def test_files_do_not_follow_the_shuffle(spark, folder):
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        write(spark, folder, 0, [(f"k{i}", i, i) for i in range(500)])
        write(spark, folder, 1, [(f"k{i}", i, i) for i in range(500)])
        assert keyed.compact(spark, folder, ["k"], upto=1) == [0, 1, 2, 3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(glob.glob(f"{folder}/rows/*/version=3/*/*.parquet")) == 4
    plan = keyed.read_keyed(spark, folder, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_older_table_takes_new_columns(spark, folder):
    write(spark, folder, 0, [("a", 1, 1), ("b", 1, 2)])
    keyed.compact(spark, folder, ["k"])
    newer = spark.createDataFrame([("a", 2, 3, "x")], SCHEMA + ", city string")
    keyed.write_changes(newer, folder, 1, ["k"], ["t"], buckets=4)
    assert {(r["k"], r["v"], r["city"]) for r in keyed.read_keyed(spark, folder, ["k"]).collect()} == {
        ("a", 3, "x"), ("b", 2, None)}


def test_diff_encode_apply_gives_the_new_state(spark):
    import random
    r = random.Random(7)
    for _ in range(3):
        state_ = lambda: {i: r.choice(["x", "y", None]) for i in r.sample(range(30), 18)}
        old, new = (spark.createDataFrame(sorted(state_().items()), "id int, name string") for _ in "ab")
        log = changes.encode(changes.capture_diff(old, new, ["id"]))
        start = old.select(F.lit("c").alias("op"), F.lit(None).cast(log.schema["before"].dataType).alias("before"),
                           F.struct("id", "name").alias("after"), F.lit(0).alias("part"), F.lit(0).alias("step"))
        events = start.unionByName(log.withColumn("step", F.lit(1)))
        got = changes.apply_changes(events, ["id"], ["step", "part"])
        assert changes.same_rows(got, new).first()["same"]


def test_same_rows_counts_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,), (None,)], "x int")
    assert changes.same_rows(a, a).first()["same"]
    assert not changes.same_rows(a, b).first()["same"]
    assert sorted((r["x"] or 0, r["surplus"]) for r in changes.differences(a, b).collect()) == [(0, -1), (1, 1)]


def test_delete_then_insert_of_one_key(spark):
    rows = event(spark, [("c", 1, "a", 1), ("d", 1, "a", 2), ("c", 1, "b", 3)])
    got = changes.apply_changes(rows, ["id"], ["ts", "seq"]).collect()
    assert [(x["id"], x["name"]) for x in got] == [(1, "b")]
