"""Document fingerprints that tell versions apart: invertible Bloom lookup sketches, in Spark expressions.

A paragraph is a line, cut further after the first sentence end past 200 characters; blank ones are
dropped and repeated ones count once. Its digest goes to one cell in each of three subtables, and a
cell holds a count, the XOR of its digests and the XOR of their checks. The sketch of one version
minus that of the other holds only the digests that differ; peeling takes out a digest wherever a cell
holds a single one. Where peeling gets stuck, larger sketches follow: digests are split into groups of
about eight by their own bits, and a group's sketch grows fourfold until it peels. If even the largest
sticks (a chance of about one in 10**6 for each group), the group's digests are compared themselves.

Null text counts as empty; empty texts are alike (1.0), and an empty and a full text are not (0.0).
Equal texts have equal fingerprints. Everything stays in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowgauge.llm.tables import plain_text

#: Cells of a subtable: the fingerprint's, then those of a group's sketches.
BASE, LARGER = 4, (4, 16, 64, 1024)
GROUP = 8
ROUNDS = 12
#: Bits of a digest that choose its cell in each subtable, its group within a block, and its block.
_CELL_BITS, _GROUP_BITS, _BLOCK_BITS = (0, 12, 24), 36, 50
_CUT = r"\G([^\n]{200,}?[.!?] |[^\n]*\n)"
BUCKET_ROWS, MOST_BUCKETS = 1000, 100_000


def let(value: Column, body) -> Column:
    """The body applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    lines = F.transform(F.split(F.regexp_replace(text, _CUT, "$1\n"), "\n"), lambda x: F.trim(x))
    return F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x)))


def _bits(key: Column, shift: int, n) -> Column:
    return F.pmod(F.shiftrightunsigned(key, shift), F.lit(n) if isinstance(n, int) else n)


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("k"), check.alias("c"))


def _added(cell: Column, key: Column, sign: Column) -> Column:
    return _cell(cell["n"] + sign, cell["k"].bitwiseXOR(key), cell["c"].bitwiseXOR(_check(key)))


_EMPTY = lambda: _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))


def sketch(keys: Column, width: Column | int) -> Column:
    """The cells of three subtables, one after the other."""
    def subtable(bits: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(width) - 1), lambda i: F.aggregate(
            F.filter(keys, lambda x: _bits(x, bits, width) == i), _EMPTY(), lambda cell, x: _added(cell, x, F.lit(1))))

    width = F.lit(width) if isinstance(width, int) else width
    return F.flatten(F.array(*map(subtable, _CELL_BITS)))


def subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(
        x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["c"].bitwiseXOR(y["c"])))


def peeled(cells: Column, width: Column | int) -> Column:
    """(left, right, ok): digests of the first sketch only, of the second only, and whether nothing is left."""
    key = lambda cell: F.struct(cell["k"].alias("k"), cell["n"].alias("n"))
    pure = lambda state: F.array_distinct(F.transform(
        F.filter(state, lambda c: (F.abs(c["n"]) == 1) & (c["c"] == _check(c["k"]))), key))

    def without(state: Column, keys: Column) -> Column:
        place = lambda k, i: (F.when(i < width, _bits(k, _CELL_BITS[0], width))
                              .when(i < F.lit(width) * 2, _bits(k, _CELL_BITS[1], width) + F.lit(width))
                              .otherwise(_bits(k, _CELL_BITS[2], width) + F.lit(width) * 2))
        return F.transform(state, lambda cell, i: F.aggregate(
            F.filter(keys, lambda p: place(p["k"], i) == i), cell, lambda x, p: _added(x, p["k"], -p["n"])))

    def step(state: Column, _: Column) -> Column:
        return F.when(state["end"], state).otherwise(let(pure(state["cells"]), lambda keys: F.struct(
            F.when(F.size(keys) == 0, state["cells"]).otherwise(without(state["cells"], keys)).alias("cells"),
            F.concat(state["keys"], keys).alias("keys"), (F.size(keys) == 0).alias("end"))))

    none = F.array().cast("array<struct<k:bigint,n:int>>")
    start = F.struct(cells.alias("cells"), none.alias("keys"), F.lit(False).alias("end"))
    side = lambda keys, n: F.transform(F.filter(keys, lambda p: p["n"] == n), lambda p: p["k"])
    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step), lambda s: F.struct(
        side(s["keys"], 1).alias("left"), side(s["keys"], -1).alias("right"),
        (~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))).alias("ok")))


def _grown(a: Column, b: Column) -> Column:
    """The difference of two groups of digests by sketches that grow until they peel."""
    none = F.array().cast("array<bigint>")
    start = F.struct(none.alias("left"), none.alias("right"), F.lit(False).alias("ok"))
    tried = F.aggregate(F.array(*map(F.lit, LARGER)), start, lambda done, width: F.when(done["ok"], done).otherwise(
        peeled(subtracted(sketch(a, width), sketch(b, width)), width)))
    compared = F.struct(F.array_except(a, b).alias("left"), F.array_except(b, a).alias("right"), F.lit(True).alias("ok"))
    return let(tried, lambda x: F.when(x["ok"], x).otherwise(compared))


def _by_groups(a: Column, b: Column) -> Column:
    """The difference by groups within blocks: the work follows n * sqrt(n) for texts of very many paragraphs."""
    blocks = F.ceil(F.sqrt((F.size(a) + F.size(b)) / F.lit(GROUP))).cast("int")
    number = F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1)
    some = lambda keys, bits, i: F.filter(keys, lambda x: _bits(x, bits, F.greatest(blocks, F.lit(1))) == i)
    block = lambda x, y: F.transform(number, lambda g: _grown(some(x, _GROUP_BITS, g), some(y, _GROUP_BITS, g)))
    parts = F.flatten(F.transform(number, lambda i: let(some(a, _BLOCK_BITS, i), lambda x: let(
        some(b, _BLOCK_BITS, i), lambda y: block(x, y)))))
    return let(parts, lambda p: F.struct(F.flatten(p["left"]).alias("left"), F.flatten(p["right"]).alias("right"),
                                         F.lit(True).alias("ok")))


def difference(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """(left, right, ok): the digests that only one of two versions has, from their sketches."""
    first = F.when(F.abs(F.size(a) - F.size(b)) <= 3 * BASE, peeled(subtracted(cells_a, cells_b), BASE))
    return let(first, lambda x: F.when(x["ok"], x).otherwise(_by_groups(a, b)))


def likeness(a: Column, b: Column, found: Column) -> Column:
    """Shared paragraphs over all paragraphs of two versions."""
    both, apart = F.size(a) + F.size(b), F.size(found["left"]) + F.size(found["right"])
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart)).cast("double")


def written(cells: Column, count: Column) -> Column:
    """A sketch as text: for each cell its count and its two sums, after the number of digests."""
    return F.concat_ws("-", count.cast("string"), F.array_join(F.transform(cells, lambda c: F.concat_ws(
        ".", F.hex(c["n"].cast("long")), F.hex(c["k"]), F.hex(c["c"]))), "-"))


def with_next(rows: DataFrame, order: str, columns: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each row with ``next_`` columns of the row that follows in descending order; the first follows the last.

    Rows go to buckets of neighbouring ids, about ``bucket_rows`` each, whose ends are ids that exist;
    the row at the top of each bucket is also sent to the bucket above, where it follows the last row. So each
    text is shuffled once. The driver holds one id for each bucket. Rows of one id are ordered by their
    columns' hash; a null id comes last.
    """
    count = max(1, min(MOST_BUCKETS, -(-rows.count() // bucket_rows)))
    ends = (rows.select(order).where(F.col(order).isNotNull()).repartitionByRange(count, order)
            .groupBy(F.spark_partition_id().alias("part")).agg(F.max(order).alias("end")))
    ends = sorted(x["end"] for x in ends.collect())
    if ends:
        known = F.array(*map(F.lit, ends))
        steps = [1 << k for k in reversed(range(len(ends).bit_length()))]
        below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, step: F.when(
            F.coalesce(F.get(known, n + step - 1) < F.col(order), F.lit(False)), n + step).otherwise(n))
        top = F.coalesce(F.get(known, F.col("_bucket")) == F.col(order), F.lit(False))
        above = F.pmod(F.col("_bucket") + 1, F.lit(len(ends)))
    else:
        below, top, above = F.lit(0), F.lit(False), F.lit(0)
    place = lambda bucket, again: F.struct(bucket.alias("_at"), F.lit(again).alias("_again"))
    here = place(F.col("_bucket"), 0)
    sent = rows.withColumn("_bucket", below).select(
        *rows.columns, F.inline(F.when(top, F.array(here, place(above, 1))).otherwise(F.array(here))))
    by = Window.partitionBy("_at").orderBy("_again", F.col(order).desc_nulls_last(), F.xxhash64(*columns))
    first = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = [F.coalesce(F.lead(c).over(by), F.first(c).over(first)).alias(f"next_{c}") for c in columns]
    return sent.select(*rows.columns, "_again", *following).where("_again = 0").drop("_again")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, and their likeness.

    The edit replaces the last half of a text's code points by as many from the start of the next
    document in descending order of the ids, or by all it has.
    """
    text = plain_text(text_column)
    rows = with_next(docs.select(F.col(id_column).alias("id"), text.alias("text")), "id", ["text"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    cut = rows.select("id", "text", F.char_length("text").alias("n"), F.concat(
        F.left("text", F.char_length("text") - half), F.left("next_text", half)).alias("edited"), "next_text")
    names = ("text", "edited", "next_text")
    known = cut.select("id", "n", F.sha2("edited", 256).alias("sha"), *[digests(F.col(c)).alias(c) for c in names])
    sketched = known.select("*", *[sketch(F.col(c), BASE).alias(f"{c}_cells") for c in names])
    pair = lambda c: difference(F.col("text"), F.col(c), F.col("text_cells"), F.col(f"{c}_cells"))
    compared = sketched.select("*", pair("edited").alias("to_edited"), pair("next_text").alias("to_next"))
    return compared.select(
        F.col("id").alias(id_column), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        written(F.col("text_cells"), F.size("text")).alias("fingerprint"),
        written(F.col("edited_cells"), F.size("edited")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited"), F.col("to_edited")).alias("near_edited"),
        likeness(F.col("text"), F.col("next_text"), F.col("to_next")).alias("near_next"),
        F.size(F.col("to_edited")["left"]).alias("n_removed"), F.size(F.col("to_edited")["right"]).alias("n_added"))
