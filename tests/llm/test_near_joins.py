import collections
import random

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import near_joins as n
from flowgauge.llm.components import components
from flowgauge.llm.tables import table
from flowgauge.llm.words import shingles, word_hashes
from tests.llm.conftest import make


def expected(rows):
    """By id: class, copy, copies and links, from all pairs that share a shingle."""
    classes = collections.defaultdict(list)
    for i, text in rows:
        classes[word_hashes(text or "").tobytes()].append((i, text or ""))
    sets = {min(v)[0]: set(shingles(v[0][1]).tolist()) for v in classes.values()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(min(a, b), max(a, b)) for v in holders.values() for k, a in enumerate(v) for b in v[:k]}
    links = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    count = collections.Counter(x for pair in links for x in pair)
    return {i: (find(min(v)[0]), min(v)[0], len(v), count[min(v)[0]]) for v in classes.values() for i, _ in v}


def got(df):
    return {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in df.collect()}


def test_prefix_is_the_longest_that_reaches_the_target():
    k = n.prefix_length(0.8, 0.999)
    assert n.recall(0.8, k) >= 0.999 > n.recall(0.8, k + 1)


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    assert got(n.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def near_group(size, changed, seed=1):
    rnd = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(size):
        words = list(base)
        for _ in range(rnd.randint(0, changed)):
            words[rnd.randrange(120)] = f"x{rnd.randrange(9)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block_rows, block_shingles", [(7, 10**6), (10**6, 900), (512, 400_000)])
def test_large_group_in_blocks(spark, monkeypatch, block_rows, block_shingles):
    monkeypatch.setattr(n, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(n, "BLOCK_SHINGLES", block_shingles)
    monkeypatch.setattr(n, "SENT_IDS", 0 if block_rows == 7 else 10**6)
    rows = near_group(60, 4) + [(100 + i, t) for i, t in near_group(5, 0)]
    want, have = expected(rows), got(n.near_duplicates(make(spark, rows)))
    assert have == want


def test_recall(spark):
    rows = [(i + 1000 * s, t.replace("w", f"g{s}w")) for s in range(40) for i, t in near_group(4, 3, seed=s)]
    want, have = expected(rows), got(n.near_duplicates(make(spark, rows)))
    links, found = (sum(x[3] for x in v.values()) for v in (want, have))
    assert links > 100 and found >= 0.99 * links


def test_representatives(spark):
    rows = near_group(20, 2) + [(50, "one two three four five six"), (51, "One two, three four five six!"), (52, "other")]
    docs = make(spark, rows).withColumn("high", F.lit("h"))
    out = n.representatives(docs)
    want = expected(rows)
    assert sorted(r.doc_id for r in out.collect()) == sorted({v[0] for v in want.values()}) and out.columns == docs.columns


def test_messy_rows(messy, no_rows):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    have = n.near_duplicates(messy)
    assert have.count() == len(rows)
    named = got(have.where("doc_id IS NOT NULL"))
    assert named[9][:2] == (1, 1) and named[7][:2] == (6, 6) and {named[i][1] for i in (2, 3, 4)} == {2}
    assert all(named[i][3] == 0 for i in (2, 3, 4, 5))
    kept = [r.doc_id for r in n.representatives(messy).collect()]
    assert sorted(x for x in kept if x is not None) == [1, 2, 5, 6, 8, 10, 12, 13, 14] and kept.count(None) == 2
    assert n.near_duplicates(no_rows).count() == 0 and n.representatives(no_rows).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (30, 30), (21, 22), (5, 40)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {9: 5, 8: 5, 7: 5, 6: 5, 5: 5, 40: 5, 20: 20, 21: 20, 22: 20}
    assert components(links.limit(0)).count() == 0


def test_one_id_may_have_several_texts(spark):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    docs = make(spark, [(1, a), (1, b), (2, a + " more"), (2, b), (3, "c d e f g h"), (3, "c d e f g h"), (0, b + " end")])
    got = sorted((r.doc_id, r.class_id, r.copy_id, r.n_copies, r.n_links) for r in n.near_duplicates(docs).collect())
    assert got == [(0, 0, 0, 1, 1), (1, 0, 1, 2, 1), (1, 1, 1, 1, 1), (2, 0, 1, 2, 1), (2, 1, 2, 1, 1), (3, 3, 3, 2, 0), (3, 3, 3, 2, 0)]
    left = sorted((r.doc_id, r.text) for r in n.representatives(docs).collect())
    assert left == sorted([(0, b + " end"), (1, a), (3, "c d e f g h")])


def test_ids_may_be_texts(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([("x", words), ("y", words + " end"), ("z", "other words here")], "doc_id string, text string")
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in n.near_duplicates(docs).collect()) == [
        ("x", "x", 1), ("y", "x", 1), ("z", "z", 0)]
    assert sorted(r.doc_id for r in n.representatives(docs).collect()) == ["x", "z"]
