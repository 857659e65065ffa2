import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import fingerprints as f
from flowgauge.llm.tables import table
from tests.llm.conftest import make


def units(text):
    text = re.sub(r"([^\n]{200,}?[.!?] |[^\n]*\n)", lambda m: m[1] + "\n", text)
    return {x.strip(" ") for x in text.split("\n") if x.strip(" ")}


def alike(a, b):
    a, b = units(a), units(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(docs, rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda x: -x[0])
    got = {r.doc_id: r for r in docs.collect()}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(text, edited)) and r.near_next == pytest.approx(alike(text, after))
    by_text = {}
    for i, text in rows:
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    check(f.fingerprints(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_buckets_join_up(spark):
    rows = [(i * i, f"text {i}\nline {i % 3}\nsame") for i in range(60)]
    out = f.with_next(make(spark, rows).withColumnRenamed("doc_id", "id"), "id", ["text"], bucket_rows=4)
    got = {r.id: r.next_text for r in out.collect()}
    want = dict(rows)
    order = sorted(want, reverse=True)
    assert got == {a: want[b] for a, b in zip(order, order[1:] + order[:1])}


def test_messy_rows(messy, no_rows):
    once = messy.where("doc_id IS NOT NULL AND doc_id <> 10")
    check(f.fingerprints(once), [(r.doc_id, r.text) for r in once.collect()])
    assert len(f.fingerprints(messy).collect()) == messy.count()
    assert f.fingerprints(no_rows).collect() == []
    [one] = f.fingerprints(once.where("doc_id = 1")).collect()
    assert one.near_next == 1.0


@pytest.mark.parametrize("shared, left, right", [(0, 0, 0), (5, 0, 1), (30, 3, 4), (10, 40, 0), (200, 60, 75), (0, 300, 300)])
def test_peeling_finds_the_difference(spark, shared, left, right):
    rnd = random.Random(shared + left)
    both, a, b = ([rnd.randint(-2**63, 2**63 - 1) for _ in range(n)] for n in (shared, left, right))
    df = spark.createDataFrame([(both + a, both + b)], "a array<long>, b array<long>")
    cells = df.withColumn("x", f.sketch(F.col("a"), f.BASE)).withColumn("y", f.sketch(F.col("b"), f.BASE))
    found = cells.select(f.difference(F.col("a"), F.col("b"), F.col("x"), F.col("y")).alias("d")).first().d
    assert sorted(found.left) == sorted(a) and sorted(found.right) == sorted(b) and found.ok
