"""Contiguous shards of near equal bytes.

Rows are ordered by id over range partitions. Each partition gives its total size; the running sum of
these totals, one row for each partition, gives every partition its offset, and a running sum inside
the partition gives every row its place in the whole. The places are cut at equal targets.

A row's size is the UTF-8 bytes of its text plus 1, null text none plus 1. Rows of one id are ordered
by the checksum of the text and by size, and further ties, which are repeated rows, by their place in
the input; a null id comes first. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowgauge.llm.tables import kept, partitions_for, plain_text


def ranged(rows: DataFrame, order: list[Column], partitions: int, name: str) -> DataFrame:
    """The rows in range partitions of an order, with the partition as ``part``, kept as a table."""
    if "part" in rows.columns:
        raise ValueError("part is taken")
    return kept(rows.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()), name)


def offsets(parts: DataFrame, size: Column) -> DataFrame:
    """For each ``part`` the bytes and rows before it, and the bytes of all. One row for each range partition."""
    totals = parts.groupBy("part").agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("bytes_all"))


def shards(docs: DataFrame, n: int = 16, id_column: str = "doc_id", text_column: str = "text",
           partitions: int | None = None) -> DataFrame:
    """id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard of each document.

    A row belongs to the shard in whose target the middle of its bytes lies, so shards follow the order
    of the ids, and each end differs from its target by half a row at most.
    """
    text = plain_text(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"))
    rows = ranged(rows.withColumn("place", F.monotonically_increasing_id()),
                  [F.col("id"), F.col("crc"), F.col("size"), F.col("place")],
                  partitions or partitions_for(docs), "sizes")
    inside = Window.partitionBy("part").orderBy("id", "crc", "size", "place")
    placed = rows.join(F.broadcast(offsets(rows, F.col("size"))), "part").select(
        "id", "size", "crc",
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("row"),
        (F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
         - F.col("size")).alias("begin"),
        "bytes_all")
    # Each end at byte k * bytes_all / n; in halves, so that the middle of a row is a whole number.
    target = F.expr(f"((2 * begin + size) * {n}) DIV (2 * bytes_all)")
    cut = kept(placed.withColumn("shard", F.least(target, F.lit(n - 1)).cast("int")), "cut")
    first = cut.groupBy("shard").agg(F.min("row").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
