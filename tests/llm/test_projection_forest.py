import random

import numpy as np
import pytest

from flowgauge.llm import projection_forest as pf
from flowgauge.llm.queries import QUERIES
from tests.llm.conftest import plain

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, query_id long, vid long"
EVERY = "id % 2 = 0"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, 1, 2, 3) for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    found = {}
    for q in queries:
        vector = np.array(dict(rows)[q], np.float32).astype(float)
        all_ = sorted(((float((vector * np.array(v, np.float32).astype(float)).sum()), i) for i, v in rows if i != q),
                      key=lambda p: (-p[0], p[1]))
        found[q] = [(i, s) for s, i in all_[:k]]
    return found


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_registered_query_finds_nine_in_ten_of_the_exact_neighbours(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = answers(QUERIES["op11_nearest"](spark, sf))
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    scores = {(q, i): s for q in want for i, s in exact(rows, [q], len(rows))[q]}
    assert all(scores[q, i] == s for q in got for i, s in got[q])


@pytest.mark.parametrize("block_rows, stream_queries", [(10, 8), (10_000, 10_000)])
def test_searching_all_leaves_is_exact_with_copies_ties_and_blocks(spark, block_rows, stream_queries):
    r = random.Random(4)
    # Small whole numbers give many ties; a third of the rows hold one vector.
    rows = [(i, [1.0, 2.0, -1.0] if i % 3 == 0 else [float(r.randint(-2, 2)) for _ in range(2)] + [1.0]) for i in range(200)]
    got = answers(pf.nearest(table(spark, rows), EVERY, 7, target_recall=1.0, sample_queries=1000, block_rows=block_rows,
                             stream_queries=stream_queries, leaves=8))
    assert got == exact(rows, range(0, 200, 2), 7)


def test_vectors_of_other_lengths_than_one_are_found_by_product(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=8) * r.uniform(0.1, 20)]) for i in range(300)]
    got = answers(pf.nearest(table(spark, rows), EVERY, 5, target_recall=0.95))
    want = exact(rows, range(0, 300, 2), 5)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (4, [0.0, 0.0]), (6, [nan, 1.0]), (8, [inf, 1.0]), (10, [None, 1.0]),
            (None, [1.0, 1.0]), (12, [1.0, 0.0, 0.0]), (14, []), (3, [2.0, 0.0]), (3, [2.0, 0.0])]
    got = answers(pf.nearest(table(spark, rows), EVERY, 20))
    assert got == {0: [(3, 2.0), (1, 0.5)]}


def test_no_rows_and_a_lone_row(spark):
    assert plain(pf.nearest(table(spark, []), EVERY)) == []
    assert plain(pf.nearest(table(spark, [(0, [1.0, 2.0])]), EVERY)) == []
    assert plain(pf.nearest(table(spark, [(1, [1.0, 2.0]), (3, [1.0, 2.0])]), EVERY)) == []


def test_queue_pops_leaves_by_what_they_miss():
    r = np.random.default_rng(0)
    x = r.normal(size=(400, 5))
    forest = pf.fitted(x, 3, 8, float(np.linalg.norm(x, axis=1).max()))
    q = forest.lifted(x[:20], queries=True)
    for row, popped in zip(q, forest.popped(x[:20], 24)):
        missed = {}
        for t in range(3):
            for leaf in range(8):
                node, worst = 7 + leaf, -np.inf
                while node:
                    up = (node - 1) // 2
                    margin = row @ forest.planes[t, up] - forest.cuts[t, up]
                    worst = max(worst, margin if node == 2 * up + 1 else -margin)
                    node = up
                missed[t * 8 + leaf] = worst
        assert sorted(popped) == list(range(24))
        order = [missed[c] for c in popped]
        assert all(a <= b + 1e-9 for a, b in zip(order, order[1:]))
    cells = forest.cells(x)
    assert all(len(set(cells[:, t])) == 8 for t in range(3))
