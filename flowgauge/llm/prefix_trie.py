"""Trie of conversation prefixes, and totals over its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. It is known by its depth and a sum, over its turns, of
128 bits of a hash of the place and of a digest of (role, text); being a sum, it is a running total that
needs no list of turns, and a very long conversation is summed in chunks. A node is named by the smallest conversation
that starts with it, and its depth.

Totals over subtrees: each round rakes the leaves into their parents and compresses chains of nodes with
one child, splicing out the nodes that come first by the number of factors 2 of their depth, never two
neighbours. So a chain of n nodes is gone after about log n rounds, each of which is a few joins. The
spliced nodes then get their totals in reverse order, each from the node it led to.

Turns are ordered by turn, null first, then role and text, so repeated rows are repeated turns. Null
roles and texts count as empty. Rows without a conversation id take no part. An empty table gives the
root alone, with no conversation, so no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowgauge.llm.tables import kept, partitions_for

WORD = "[^\\x20\\x09-\\x0D]+"
CHUNK = 4096          # turns of a conversation that are summed together
IDS_TOGETHER = 16384  # conversation ids that are joined to one text at a time


def ordered_turns(turns: DataFrame) -> DataFrame:
    """c, place (from 1 in each conversation), x, y (60 bits each of a digest of role and text), words.

    The rows are sorted over range partitions, ties cut by their place in the input, so a conversation of any
    length, or a row repeated any number of times, is spread. A turn's place is its number in the whole order
    less that of the first turn of its conversation. Texts are shuffled once and go no further.
    """
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("input"))
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    x, y = (F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(2))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("input")]
    rows = kept(rows.repartitionByRange(partitions_for(turns), *order).sortWithinPartitions(*order).select(
        "c", F.monotonically_increasing_id().alias("row"), x.alias("x"), y.alias("y"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "ordered")
    part = F.shiftright("row", 33)  # how Spark numbers rows: the partition above 33 bits of the place in it
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))  # a row a partition
    numbered = rows.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "c", (F.col("offset") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("number"), "x", "y", "words")
    first = numbered.groupBy("c").agg(F.min("number").alias("first"))
    return numbered.join(first, "c").select("c", (F.col("number") - F.col("first") + 1).alias("place"), "x", "y", "words")


def rebuilt(turns: DataFrame, block: int = 20, kinds: int = 4) -> tuple[DataFrame, DataFrame]:
    """All conversation ids (c), and the turns (c, place, x, y, words) of the rebuilt conversations.

    A conversation takes the first h turns of the first of its block of ids, then its own after the h-th.
    """
    placed = kept(ordered_turns(turns), "turns")
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % kinds).cast("long")
    ids = kept(placed.groupBy("c").agg(F.count(F.lit(1)).alias("turns")).select(
        "c", "turns", (F.col("c") - F.col("c") % block).alias("of"), h.alias("h")), "conversations")
    turn = ["x", "y", "words"]
    heads = placed.where(F.col("place") < kinds).withColumnsRenamed({"c": "of"})
    lent = ids.join(heads, "of").where("place <= h").select("c", "place", *turn)
    sizes = ids.select(F.col("c").alias("of"), F.col("turns").alias("of_turns"))
    own = ids.join(sizes, "of", "left").select(
        "c", "h", (F.col("h") - F.least("h", F.coalesce("of_turns", F.lit(0)))).alias("short"))
    rest = placed.join(own, "c").where("place > h").select("c", (F.col("place") - F.col("short")).alias("place"), *turn)
    return ids.select("c"), lent.unionByName(rest)


def prefixes(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """c, d, x, y, px, py, words: each conversation's prefix of each length d from 1, its name (x, y) and its parent's."""
    x, y = (F.xxhash64(F.lit(i), "place", "x", "y").cast("decimal(20,0)") for i in (1, 2))
    rows = kept(turns.select("c", "place", x.alias("x"), y.alias("y"), "words",
                             F.floor(F.col("place") / chunk).alias("cell")), "digests")
    cells = rows.groupBy("c", "cell").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    earlier = Window.partitionBy("c").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # Only the chunks after the first of a long conversation have something before them.
    before = cells.select("c", "cell", F.sum("x").over(earlier).alias("bx"), F.sum("y").over(earlier).alias("by")).where(
        "bx IS NOT NULL")
    inside = Window.partitionBy("c", "cell").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("c", "cell", "place", "words", "x", "y",
                         F.sum("x").over(inside).alias("sx"), F.sum("y").over(inside).alias("sy"))
    wide = lambda column: column.cast("decimal(38,0)")
    total = lambda own, moved: wide(wide(F.col(own)) + wide(F.coalesce(F.col(moved), F.lit(0))))
    return summed.join(before, ["c", "cell"], "left").select(
        "c", F.col("place").alias("d"), total("sx", "bx").alias("x"), total("sy", "by").alias("y"), "words",
        F.col("x").alias("own_x"), F.col("y").alias("own_y")).select(
        "c", "d", "x", "y", wide(F.col("x") - F.col("own_x")).alias("px"),
        wide(F.col("y") - F.col("own_y")).alias("py"), "words")


def nodes(ids: DataFrame, found: DataFrame) -> DataFrame:
    """c, d, pc, n, words of every node: smallest member, depth, parent's smallest member, members, words of its last turn."""
    named = kept(found.groupBy("d", "x", "y").agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("n"), F.first("px").alias("px"), F.first("py").alias("py"),
        F.first("words").alias("words")), "nodes")
    root = ids.agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n")).where("n > 0")
    above = named.select((F.col("d") + 1).alias("d"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("c").alias("pc"))
    top = root.select(F.lit(1).cast("long").alias("d"), F.lit(0).cast("decimal(38,0)").alias("px"),
                      F.lit(0).cast("decimal(38,0)").alias("py"), F.col("c").alias("pc"))
    children = named.join(above.unionByName(top), ["d", "px", "py"]).select("c", "d", "pc", "n", "words")
    return children.unionByName(root.select(
        "c", F.lit(0).cast("long").alias("d"), F.lit(None).cast("long").alias("pc"), "n", F.lit(0).cast("long").alias("words")))


def _factors_two(depth: Column) -> Column:
    """How often 2 divides a depth: the place of its lowest bit."""
    return F.bit_count(F.bitwise_not(depth).bitwiseAND(depth - 1))


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """c, d and, for each value column, its sum over the subtree of (c, d); the parent of a node is (pc, pd), null for the root."""
    sums = lambda prefix="": [F.sum(prefix + v).alias("raked_" + v) for v in values]
    alive = kept(tree.select("c", "d", "pc", "pd", *values), "alive")
    done, spliced = [], []
    while True:
        kids = alive.where("pc IS NOT NULL").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
            F.count(F.lit(1)).alias("kids"), F.max("c").alias("kc"), F.max("d").alias("kd"))
        state = kept(alive.join(kids, ["c", "d"], "left"), "state")
        leaves = state.where("kids IS NULL")
        done.append(leaves.select("c", "d", *values))
        inner = state.where("kids IS NOT NULL")
        if inner.isEmpty():
            break
        # Rake: totals of leaves go to their parents.
        raked = leaves.groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(F.count(F.lit(1)).alias("raked"), *sums())
        inner = kept(inner.join(raked, ["c", "d"], "left").select(
            "c", "d", "pc", "pd", "kc", "kd", ((F.col("kids") == 1) & F.col("raked").isNull()).alias("single"),
            *[(F.col(v) + F.coalesce("raked_" + v, F.lit(0))).alias(v) for v in values]), "inner")
        # Compress: of the chain links (u below v, both with one child), those before both neighbours in order.
        rank = F.struct(_factors_two(F.col("d")), F.xxhash64("c", "d", F.lit(len(done))))
        chain = inner.where("single").select("c", "d", "pc", "pd", "kc", "kd", rank.alias("rank"), *values)
        above = chain.select(F.col("c").alias("pc"), F.col("d").alias("pd"), F.col("rank").alias("above"))
        below = chain.select(F.col("c").alias("kc"), F.col("d").alias("kd"), F.col("rank").alias("below"))
        out = kept(chain.join(above, ["pc", "pd"]).join(below, ["kc", "kd"], "left").where(
            (F.col("rank") < F.col("above")) & (F.col("below").isNull() | (F.col("rank") < F.col("below")))).select(
            "c", "d", "pc", "pd", "kc", "kd", *values), "spliced")
        spliced.append(out)
        # A spliced node's value goes to its parent, its parent to its child.
        lifted = out.select(F.col("pc").alias("c"), F.col("pd").alias("d"), *[F.col(v).alias("raked_" + v) for v in values])
        moved = out.select(F.col("kc").alias("c"), F.col("kd").alias("d"), F.col("pc").alias("npc"), F.col("pd").alias("npd"))
        alive = kept(
            inner.join(out.select("c", "d"), ["c", "d"], "left_anti").join(lifted, ["c", "d"], "left").join(moved, ["c", "d"], "left").select(
                "c", "d", F.coalesce("npc", "pc").alias("pc"), F.coalesce("npd", "pd").alias("pd"),
                *[(F.col(v) + F.coalesce("raked_" + v, F.lit(0))).alias(v) for v in values]), "alive")
    finished = reduce(DataFrame.unionByName, done)
    return finished.unionByName(expanded(finished, spliced, values))


def expanded(finished: DataFrame, spliced: list[DataFrame], values: list[str]) -> DataFrame:
    """Totals of the nodes that were spliced out, last round first: own value and the total of the node it led to."""
    cut = reduce(DataFrame.unionByName, [s.select("c", "d", "kc", "kd") for s in spliced]) if spliced else None
    if cut is None:
        return finished.limit(0)
    asked = cut.select(F.col("kc").alias("c"), F.col("kd").alias("d"))
    known = kept(finished.join(asked, ["c", "d"], "left_semi"), "known")  # a node is led to by one spliced node a round
    parts = [known]
    for out in reversed(spliced):
        below = reduce(DataFrame.unionByName, parts).withColumnsRenamed(
            {"c": "kc", "d": "kd", **{v: "below_" + v for v in values}})
        parts.append(kept(out.join(below, ["kc", "kd"]).select(
            "c", "d", *[(F.col(v) + F.col("below_" + v)).alias(v) for v in values]), "expanded"))
    return reduce(DataFrame.unionByName, parts[1:])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined parts of each node; parts of a node come one after the other."""
    node, state = None, None
    for batch in batches:
        c, d, sha = [], [], []
        for a, b, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)]):
            if (a, b) == node:
                state.update(b"," + text.encode())
                continue
            if node is not None:
                c.append(node[0]), d.append(node[1]), sha.append(state.hexdigest())
            node, state = (a, b), hashlib.sha256(text.encode())
        yield pa.record_batch([pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(sha, pa.string())], ["c", "d", "sha"])
    if node is not None:
        yield pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()),
                               pa.array([state.hexdigest()], pa.string())], ["c", "d", "sha"])


def end_hashes(ends: DataFrame, together: int = IDS_TOGETHER) -> DataFrame:
    """c, d, sha: SHA-256 of the ids of the conversations that end at each node, ascending, comma-joined.

    Ids are joined in ranges of ``together`` numbers; the digest then runs over the texts of the ranges, one
    after the other, without holding them.
    """
    cell = F.floor(F.col("conversation") / together)
    texts = ends.groupBy("c", "d", cell.alias("cell")).agg(
        F.array_join(F.sort_array(F.collect_set("conversation")), ",").alias("ids"))
    return texts.repartition("c", "d").sortWithinPartitions("c", "d", "cell").mapInArrow(_hashed, "c long, d long, sha string")


def prefix_trie(turns: DataFrame, rebuild: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = rebuilt) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    ids, built = rebuild(turns)
    found = kept(prefixes(built), "prefixes")
    tree = kept(nodes(ids, found).withColumn("pd", F.when(F.col("pc").isNotNull(), F.col("d") - 1)), "tree")
    # The node at which each conversation ends, by name; a conversation without turns ends at the root.
    last = ids.select("c").join(found.groupBy("c").agg(F.max(F.struct("d", "x", "y")).alias("last")), "c", "left").select(
        F.col("c").alias("conversation"), F.coalesce("last.d", F.lit(0)).alias("d"),
        F.coalesce("last.x", F.lit(0).cast("decimal(38,0)")).alias("x"),
        F.coalesce("last.y", F.lit(0).cast("decimal(38,0)")).alias("y"))
    names = kept(found.groupBy("d", "x", "y").agg(F.min("c").alias("c")).unionByName(ids.agg(F.min("c").alias("c")).select(
        F.lit(0).cast("long").alias("d"), F.lit(0).cast("decimal(38,0)").alias("x"),
        F.lit(0).cast("decimal(38,0)").alias("y"), "c")), "names")
    hashes = end_hashes(last.join(names, ["d", "x", "y"]).select("c", "d", "conversation"))
    children = tree.where("pc IS NOT NULL").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
        F.count(F.lit(1)).alias("n_children"))
    tree = kept(tree.join(children, ["c", "d"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
        "leaves": F.col("n_children").isNull().cast("long"),
        "saved": ((F.col("n") - 1) * F.col("words")).cast("long")}), "children")
    totals = subtree_sums(tree, ["leaves", "saved"])
    return tree.drop("leaves", "saved").join(totals, ["c", "d"]).join(hashes, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
