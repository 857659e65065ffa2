"""Change data capture: capture, encode, decode, apply, compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sources.records import as_struct, parse_json, split_valid_invalid
from .ordered import latest_per_key


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, time: Column, sequence: Column) -> DataFrame:
    """All rows of a table as ``op = 'r'``, followed by its changes (``op, before, after, ts, seq``)."""
    row = F.struct(*[F.col(c) for c in snapshot.columns])
    image = snapshot.select(F.lit("r").alias("op"), F.lit(None).cast(row_type(snapshot)).alias("before"),
                            row.alias("after"), time.alias("ts"), sequence.alias("seq"))
    return image.unionByName(changes.select("op", "before", "after", "ts", "seq"))


def interleaved_snapshot(chunks: DataFrame, changes: DataFrame, keys: Sequence[str], low: str = "low",
                         high: str = "high") -> DataFrame:
    """A snapshot that was read chunk by chunk while changes went on, and the changes, as one log.

    ``chunks`` has the rows of the table as they were read, each with the
    positions of the log before (``low``) and after (``high``) its chunk was
    read; a chunk is a range of keys.  What a row saw of the changes between
    the two is unknown, so where its key changes between them the change wins
    and the row is left out.  The others come as ``op = 'r'`` at the low mark:
    before all changes that they may lack.  ``part`` puts them after the change
    at that very position.  Events from the lowest mark on are enough.
    """
    fields = [c for c in chunks.columns if c not in (low, high)]
    images = F.array_compact(F.array(F.col("before"), F.col("after")))
    touched = changes.select(F.col("seq").alias("_seq"), F.explode(images).alias("_row")).select(
        "_seq", *[F.col(f"_row.{k}").alias(f"_{k}") for k in keys])
    between = (F.col("_seq") > F.col(low)) & (F.col("_seq") <= F.col(high))
    for k in keys:
        between = F.col(k).eqNullSafe(F.col(f"_{k}")) & between
    row = F.struct(*[F.col(c) for c in fields])
    nothing = F.lit(None).cast(changes.schema["before"].dataType)
    read = chunks.join(touched, between, "left_anti").select(
        F.lit("r").alias("op"), nothing.alias("before"), row.alias("after"), F.col(low).alias("seq"), F.lit(1).alias("part"))
    return read.unionByName(changes.select("op", "before", "after", "seq", F.lit(0).alias("part")))


def row_type(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


def capture_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes between two states of a table: ``op`` c, u or d with both row images."""
    columns = old.columns
    o = old.select(F.struct(*columns).alias("before"))
    n = new.select(F.struct(*columns).alias("after"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"before.{k}") == F.col(f"after.{k}"))
    op = (F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d")
          .when(~F.col("before").eqNullSafe(F.col("after")), "u"))
    return o.join(n, condition, "full").select(op.alias("op"), "before", "after").filter(F.col("op").isNotNull())


def encode(changes: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Changes as log events: an update becomes a delete of the old row, then a create of the new one.

    ``part`` is 0 or 1 and orders the two events of an update.
    """
    nothing = F.lit(None).cast(changes.schema["before"].dataType)
    event = lambda op, before, after, part: F.struct(
        F.lit(op).alias("op"), before.alias("before"), after.alias("after"), F.lit(part).alias("part"))
    update = F.array(event("d", F.col("before"), nothing, 0), event("c", nothing, F.col("after"), 1))
    create = F.array(event("c", nothing, F.col("after"), 0))
    delete = F.array(event("d", F.col("before"), nothing, 0))
    events = F.when(F.col("op") == "u", update).when(F.col("op") == "d", delete).otherwise(create)
    return changes.select(*order, F.inline(events))


def to_change_json(events: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Log events as key and value text."""
    key = F.to_json(F.struct(*[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys]))
    value = F.to_json(F.struct("before", "after", "op", *extra), {"ignoreNullFields": "false"})
    return events.withColumns({"key": key, "value": value})


def decode(records: DataFrame, row_schema: str | T.StructType,
           value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log event text to ``op, before, after, ts_ms``; accepts c, u, d and r.

    The second table has the other records, with their text in ``decoded`` and
    the ``reason``: unreadable, or an unknown operation.
    """
    row = as_struct(row_schema)
    schema = T.StructType([T.StructField("before", row), T.StructField("after", row),
                           T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    parsed = parse_json(records, schema, value, out="_event")
    good, bad = split_valid_invalid(parsed, F.col("_event.op").isin("c", "u", "d", "r"))
    reason = F.when(F.col("_event").isNull(), "unreadable").otherwise("unknown operation")
    return (good.select("*", "_event.*").drop("_event", "decoded"),
            bad.withColumn("reason", reason).drop("_event"))


def apply_changes(events: DataFrame, keys: Sequence[str], order: Sequence[str],
                  keep_deleted: bool = False) -> DataFrame:
    """State of the table after the changes, in any arrival order.

    Per key the last event by ``order`` counts: its ``after`` image, or no row
    if it deletes.  With ``keep_deleted`` deletes stay as rows with
    ``_deleted`` so that older changes arriving later cannot bring them back.
    An update that changes the key deletes the old key and creates the new one.
    """
    fields = [f.name for f in events.schema["after"].dataType]
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    moved = (F.col("op") == "u") & F.col("before").isNotNull() & F.col("after").isNotNull() & moved
    image = lambda row, deleted: F.struct(row.alias("row"), deleted.alias("_deleted"))
    images = F.when(moved, F.array(image(F.col("before"), F.lit(True)), image(F.col("after"), F.lit(False)))).otherwise(
        F.array(image(F.coalesce("after", "before"), F.col("op") == "d")))
    flat = events.select(*[c for c in order if c not in fields], F.inline(images)).select(
        *[F.col(f"row.{f}").alias(f) for f in fields], "_deleted", *[c for c in order if c not in fields])
    last = latest_per_key(flat, keys, order)
    if keep_deleted:
        return last
    return last.filter(~F.col("_deleted")).select(*fields)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, counting repeats; empty when both hold the same rows."""
    columns = a.columns
    tagged = a.withColumn("_n", F.lit(1)).unionByName(b.select(*columns).withColumn("_n", F.lit(-1)))
    return (
        tagged.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)
    )


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether both tables hold the same rows."""
    return differences(a, b).agg((F.count(F.lit(1)) == 0).alias("same"))
