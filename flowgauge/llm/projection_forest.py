"""Nearest neighbours by inner product, from a forest of random-projection trees.

The trees are fitted on a bounded sample of the vectors (``SAMPLE_ROWS``): each node splits its rows at
the median of their projection onto the difference of two random ones. Every vector is then indexed,
in one leaf of every tree. A query keeps one priority queue for all trees: the node whose splits it
misses by least comes next, and each leaf that is popped is searched. How many leaves are popped is
measured, not set: for a sample of the queries the exact neighbours among all rows are found, and the
least number of leaves that gives ``target_recall`` of them is taken. Candidates of a leaf are ranked by
the exact inner product of the original vectors in double precision.

For inner products the trees see vectors with one more component that gives all the same length, and
queries with a zero there, so that the nearest directions are the largest products.

Leaves are cut into blocks of bounded size; a task holds one block and lets the queries stream past it.
Equal vectors are indexed once, under their smallest id, and their ids are put in again at the end, so a
vector that a third of all rows share is one row of the index.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an
id, nor vectors of another length than the commonest (ties: the longest). Of several vectors of one id
the smallest counts, so repeated rows count once. Ties of the product go to the smaller id. Without
vectors, or without queries, there are no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowgauge.llm.tables import kept

SAMPLE_ROWS = 32_768     # rows that the trees are fitted on
SAMPLE_QUERIES = 128     # queries whose exact neighbours decide how far to search
TREES = 6
LEAVES = 64              # of a tree, up to LEAVES_AT rows; twice as many for each four times as many rows
LEAVES_AT = 1 << 20
MOST_LEAVES = 1024
LEAST_IN_LEAF = 32
BLOCK_ROWS = 16_384      # vectors of a leaf that a task holds
STREAM_QUERIES = 250_000  # queries that pass one block in one task
TOGETHER = 256           # queries that are multiplied at a time


@dataclass
class Forest:
    """Split planes of all trees. Node i of a tree has the children 2i + 1 and 2i + 2; leaves come last."""

    planes: np.ndarray   # trees, inner nodes, components
    cuts: np.ndarray     # trees, inner nodes
    length: float        # that all vectors get

    @property
    def leaves(self) -> int:
        return self.cuts.shape[1] + 1

    def lifted(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """Vectors with the component that makes them equally long; queries are scaled and get a zero."""
        norms = np.linalg.norm(vectors, axis=1)
        if queries:
            return np.column_stack([vectors * (self.length / norms)[:, None], np.zeros(len(vectors))])
        return np.column_stack([vectors, np.sqrt(np.maximum(self.length ** 2 - norms ** 2, 0))])

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered over all trees."""
        x = self.lifted(vectors)
        out = np.empty((len(x), len(self.planes)), np.int32)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(cuts):
                side = np.einsum("ij,ij->i", x, planes[node]) > cuts[node]
                node = 2 * node + 1 + side
            out[:, t] = t * self.leaves + node - len(cuts)
        return out

    def popped(self, vectors: np.ndarray, most: int) -> list[list[int]]:
        """For each query the first ``most`` leaves that its queue over all trees gives."""
        trees, inner = self.cuts.shape
        x = self.lifted(vectors, queries=True)
        margins = (x @ self.planes.reshape(trees * inner, x.shape[1]).T).reshape(len(x), trees, inner) - self.cuts
        out = []
        for of in margins.tolist():
            queue = [(-np.inf, t, 0) for t in range(trees)]  # missed by, tree, node
            cells = []
            while queue and len(cells) < most:
                missed, t, node = heapq.heappop(queue)
                if node >= inner:
                    cells.append(t * self.leaves + node - inner)
                    continue
                margin = of[t][node]
                heapq.heappush(queue, (max(missed, margin), t, 2 * node + 1))
                heapq.heappush(queue, (max(missed, -margin), t, 2 * node + 2))
            out.append(cells)
        return out


def fitted(sample: np.ndarray, trees: int, leaves: int, length: float, seed: int = 0) -> Forest:
    """A forest from sampled vectors; ``leaves`` is a power of two."""
    random = np.random.default_rng(seed)
    forest = Forest(np.zeros((trees, leaves - 1, sample.shape[1] + 1)), np.zeros((trees, leaves - 1)), length)
    x = forest.lifted(sample)
    for t in range(trees):
        rows = {0: np.arange(len(x))}
        for node in range(leaves - 1):
            own = rows.pop(node)
            pool = own if len(own) > 1 else np.arange(len(x))
            a, b = x[random.choice(pool, 2, replace=len(pool) < 2)]
            plane = a - b
            if not plane.any():
                plane = random.normal(size=x.shape[1])
            plane /= np.linalg.norm(plane)
            at = x[own] @ plane
            cut = float(np.median(at)) if len(own) else 0.0
            forest.planes[t, node], forest.cuts[t, node] = plane, cut
            rows[2 * node + 1], rows[2 * node + 2] = own[at <= cut], own[at > cut]
    return forest


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, each added up in the same way wherever it is computed."""
    return (a * b).sum(axis=1)


def best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its place) the ``k`` nearest ids and their products, ties to smaller ids."""
    for begin in range(0, len(queries), TOGETHER):
        part = queries[begin:begin + TOGETHER]
        rough = part @ vectors.T
        if rough.shape[1] > k:
            # Whatever may be among the k best after rounding, ties included, is computed again pair by pair.
            floor = np.partition(rough, rough.shape[1] - k, axis=1)[:, -k]
            slack = 1e-12 * (1 + np.linalg.norm(part, axis=1) * np.linalg.norm(vectors, axis=1).max())
            mask = rough >= (floor - slack)[:, None]
        else:
            mask = np.ones(rough.shape, bool)
        for i in range(len(part)):
            which = np.flatnonzero(mask[i])
            score = products(np.broadcast_to(part[i], (len(which), part.shape[1])), vectors[which])
            order = np.lexsort((ids[which], -score))[:k]
            yield begin + i, ids[which][order], score[order]


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def packed(vectors: np.ndarray) -> pa.Array:
    """Vectors as bytes."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(vectors, np.float64)], pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.float64)
    return flat.reshape(len(column), -1)


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector of the rows that take part, one for each id."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col(id_column).isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda v: v != 0)).select(
        F.col(id_column).cast("long").alias("id"), x.alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if commonest is None:
        return rows
    return rows.where(F.size("vector") == commonest["length"]).groupBy("id").agg(F.min("vector").alias("vector"))


def _exact(queries: np.ndarray, k: int):
    """For ``mapInArrow``: the nearest rows of a partition to each of a few queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = np.empty(0, np.int64), np.empty((0, queries.shape[1]))
        held = [(ids, vectors)] * len(queries)
        for batch in batches:
            new_ids, new = batch.column("vid").to_numpy(), matrix(batch.column("vector"))
            for q, near, _ in list(best(queries, new, new_ids, k)):
                where = np.searchsorted(new_ids, near, sorter=(order := np.argsort(new_ids)))
                ids = np.concatenate([held[q][0], near])
                vectors = np.concatenate([held[q][1], new[order[where]]])
                (_, top, _), = best(queries[q:q + 1], vectors, ids, k)
                place = {v: i for i, v in enumerate(ids)}
                held[q] = (top, vectors[[place[v] for v in top]])
        for q, (ids, vectors) in enumerate(held):
            score = products(np.broadcast_to(queries[q], vectors.shape), vectors)
            yield pa.record_batch([pa.array([q] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(score), packed(vectors)],
                                  ["q", "vid", "score", "v"])
    return run


def leaves_to_pop(forest: Forest, vectors: DataFrame, queries: np.ndarray, k: int, target: float) -> tuple[int, float]:
    """The least number of leaves that finds ``target`` of the exact neighbours of some queries, and what it finds."""
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vid"))
    rows = vectors.mapInArrow(_exact(queries, k), "q int, vid long, score double, v binary").withColumn("place", first).where(
        F.col("place") <= k).select("q", "v").collect()
    order = forest.popped(queries, forest.leaves * len(forest.planes))
    turns = []
    for q in range(len(queries)):
        near = [r["v"] for r in rows if r["q"] == q]
        if near:
            turn = np.empty(forest.leaves * len(forest.planes), np.int64)
            turn[order[q]] = np.arange(len(turn))
            turns.append(turn[forest.cells(np.frombuffer(b"".join(near), np.float64).reshape(len(near), -1))].min(axis=1))
    turns = np.sort(np.concatenate(turns)) if turns else np.zeros(1, np.int64)
    need = max(int(np.ceil(target * len(turns))) - 1, 0)
    pops = int(turns[need]) + 1
    return pops, float((turns < pops).mean())


def _indexed(forest: Forest, blocks: int, copies: int):
    """For ``mapInArrow``: each vector once for each tree, in its leaf's block, and for each share of the queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("vid").to_numpy(), matrix(batch.column("vector"))
            if not len(ids):
                continue
            cells, v = forest.cells(x), packed(x)
            block = pa.array(((ids * 2654435761) % (1 << 32) * blocks >> 32).astype(np.int32))
            for t in range(cells.shape[1]):
                for share in range(copies):
                    yield pa.record_batch([
                        pa.array(cells[:, t]), block, pa.array(np.full(len(ids), share, np.int32)),
                        pa.array(np.zeros(len(ids), np.int32)), pa.array(ids), v], ["cell", "block", "share", "asks", "vid", "v"])
    return run


def _asking(forest: Forest, pops: int, blocks: int, copies: int):
    """For ``mapInArrow``: each query once for each leaf it pops, and for each block of that leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, TOGETHER) for i in range(0, batch.num_rows, TOGETHER)):
                ids, x = part.column("vid").to_numpy(), matrix(part.column("vector"))
                cells = forest.popped(x, pops)
                who = np.repeat(np.arange(len(ids)), [len(c) for c in cells])
                share = pa.array(((ids * 2654435761) % (1 << 32) * copies >> 32).astype(np.int32)[who])
                v = packed(x).take(pa.array(who))
                for block in range(blocks):
                    yield pa.record_batch([
                        pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.full(len(who), block, np.int32)), share,
                        pa.array(np.ones(len(who), np.int32)), pa.array(ids[who]), v],
                        ["cell", "block", "share", "asks", "vid", "v"])
    return run


INDEX = "cell int, block int, share int, asks int, vid long, v binary"


def _ranked(k: int):
    """For ``mapInArrow`` over rows sorted by cell, block, share and asks: vectors are held, then queries pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ids, vectors = None, [], None, None
        for batch in batches:
            cell, block, share, asks = (batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "block", "share", "asks"))
            new = np.flatnonzero(np.diff(cell) | np.diff(block) | np.diff(share) | np.diff(asks)) + 1
            for begin, end in zip([0, *new], [*new, batch.num_rows]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                key = (cell[begin], block[begin], share[begin])
                if key != now:
                    now, held, ids = key, [], None
                if not asks[begin]:
                    held.append((part.column("vid").to_numpy(), unpacked(part.column("v"))))
                    continue
                if not held:  # a leaf without vectors
                    continue
                if ids is None:
                    ids, vectors = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                asked = part.column("vid").to_numpy()
                q, near, score = [], [], []
                for i, top, products_ in best(unpacked(part.column("v")), vectors, ids, k):
                    q.append(np.full(len(top), asked[i]))
                    near.append(top)
                    score.append(products_)
                yield pa.record_batch([pa.array(np.concatenate(q)), pa.array(np.concatenate(near)), pa.array(np.concatenate(score))],
                                      ["q", "vid", "score"])
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("vector"))
        yield pa.record_batch([batch.column("vid"), batch.column("vid"), pa.array(products(x, x))], ["q", "vid", "score"])


def nearest(rows: DataFrame, is_query: str, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            trees: int = TREES, target_recall: float = 0.97, sample_rows: int = SAMPLE_ROWS,
            sample_queries: int = SAMPLE_QUERIES, block_rows: int = BLOCK_ROWS,
            stream_queries: int = STREAM_QUERIES, leaves: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows found for each row that meets the condition ``is_query`` on ``id``."""
    result = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    vectors = kept(usable(rows, id_column, vector_column), "vectors")
    # Equal vectors under their smallest id.
    groups = kept(vectors.groupBy("vector").agg(F.min("id").alias("vid"), F.count(F.lit(1)).alias("n")), "distinct")
    single = groups.select("vid", "vector")
    shared = groups.where("n > 1")
    members = kept(vectors.join(shared.select("vector", "vid"), "vector").select("vid", "id"), "members")
    alone = groups.where("n = 1").select("vid", F.col("vid").alias("id"))
    asked = kept(alone.unionByName(members).where(is_query), "asked")
    asking = kept(single.join(asked.select("vid").distinct(), "vid", "left_semi"), "asking")
    total, queries = single.count(), asking.count()
    if not queries:
        return spark.createDataFrame([], result)

    bits = 1 << 20
    share = lambda part, of: F.pmod(F.xxhash64("vid"), F.lit(bits)) < int(min(1, part / of) * bits) + 1
    sample = np.array([r["vector"] for r in single.where(share(sample_rows, total)).collect()], np.float64)
    probe = np.array([r["vector"] for r in asking.where(share(sample_queries, queries)).collect()], np.float64)
    if not len(probe):
        probe = np.array([r["vector"] for r in asking.limit(sample_queries).collect()], np.float64)
    if not len(sample):
        sample = probe
    length = single.agg(F.sqrt(F.max(F.aggregate(
        "vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))).first()[0]
    if leaves is None:
        leaves = LEAVES
        while leaves < MOST_LEAVES and total > LEAVES_AT * (leaves // LEAVES) ** 2:
            leaves *= 2
        while leaves > 1 and leaves * LEAST_IN_LEAF > total:
            leaves //= 2
    forest = fitted(sample, trees, leaves, length)
    pops, _ = leaves_to_pop(forest, single, probe, k + 1, target_recall)

    # Leaves are cut at medians of a sample, so a block holds about block_rows of its leaf.
    blocks, copies = -(-total // (leaves * block_rows)), -(-queries // stream_queries)
    index = single.mapInArrow(_indexed(forest, blocks, copies), INDEX)
    asks = asking.mapInArrow(_asking(forest, pops, blocks, copies), INDEX)
    found = index.unionByName(asks).repartition("cell", "block", "share").sortWithinPartitions(
        "cell", "block", "share", "asks").mapInArrow(_ranked(k + 1), "q long, vid long, score double")
    # A query's own vector stands for the other ids that share it.
    own = asking.join(shared.select("vid"), "vid", "left_semi").mapInArrow(_own, "q long, vid long, score double")
    nearest_first = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    top = found.unionByName(own).repartition("q").groupBy("q", "vid").agg(F.max("score").alias("score")).withColumn(
        "place", F.row_number().over(nearest_first)).where(F.col("place") <= k + 1).select("q", "vid", "score")
    # Of the ids that share a vector the smallest k + 1 can be among the nearest; first by shares of a group.
    some = Window.partitionBy("vid", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    smallest = Window.partitionBy("vid").orderBy("id")
    few = members.withColumn("place", F.row_number().over(some)).where(F.col("place") <= k + 1).withColumn(
        "place", F.row_number().over(smallest)).where(F.col("place") <= k + 1).groupBy("vid").agg(F.collect_list("id").alias("ids"))
    lists = top.join(few, "vid", "left").select(
        "q", "score", F.explode(F.coalesce("ids", F.array("vid"))).alias("vec_id")).groupBy("q").agg(
        F.collect_list(F.struct("vec_id", "score")).alias("near"))  # (k + 1) squared at most
    answers = asked.join(lists, asked["vid"] == lists["q"]).select(
        F.col("id").alias("query_id"), F.explode("near").alias("near")).select("query_id", "near.vec_id", "near.score").where(
        "vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
