"""Latest-state views fed by a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.epoch import epoch_us, floor_div
from ..operators.views import fold_registers, merge_registers, values_of, within_retention
from . import keyed


def _merge(fields: Sequence[str] | None) -> keyed.Merge:
    """Registers are folded field by field; a view row is never deleted."""
    def merge(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        own = fields or [c for c in rows.columns if c not in (*keys, *keyed.OWN, "_deleted")]
        return merge_registers(rows, keys, own, newest=keyed.OWN).withColumn("_deleted", F.lit(False))
    return merge


def _row_time(time: str, ignore_nulls: bool) -> Column:
    return F.col(f"`{time}`.value") if ignore_nulls else F.col(f"`{time}`")


def view_sink(path: str, keys: Sequence[str], order: Sequence[str], ignore_nulls: bool = False,
              buckets: int = keyed.HASH_PARTITIONS, time: str | None = None,
              retention: int = 300) -> Callable[[DataFrame, int], None]:
    """Sink that feeds a view.

    With ``ignore_nulls`` the stored row of a key has a register for each
    column: the last non-null value and the order key it came with, so rows
    fold in any grouping.  Other rows lie in slots of ``retention`` seconds of
    ``time`` (the first order column if not given), which :func:`expire` drops
    whole once all their rows are too old.  Registers are not dropped that way
    and lie in one slot: a slot is a folder, and a file, for each bucket.
    """
    time = time or order[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ignore_nulls:
            slot = floor_div(_us(F.col(f"`{time}`"), batch, time), retention * 1_000_000)
            keyed.write_changes(batch, path, batch_id, keys, order, buckets, slot=F.coalesce(slot, F.lit(0)))
            return
        fields = [c for c in batch.columns if c not in keys]
        keyed.write_changes(fold_registers(batch, keys, fields, order), path, batch_id, keys, buckets=buckets, unique=True)
    return write


def _us(column: Column, df: DataFrame, time: str) -> Column:
    """Microseconds of a time column, which may be a number of microseconds already."""
    return epoch_us(column) if dict(df.dtypes)[time].startswith("timestamp") else column.cast("bigint")


def _rows(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], ignore_nulls: bool) -> DataFrame | None:
    rows = keyed.read_keyed(spark, path, keys, order, merge=_merge(None) if ignore_nulls else None)
    if rows is None or not ignore_nulls:
        return rows
    return values_of(rows, keys, [c for c in rows.columns if c not in keys])


def read_view(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], *,
              ignore_nulls: bool = False, as_of: Column | None = None, retention: int = 300,
              time: str | None = None) -> DataFrame | None:
    """Rows of a view; rows last written more than ``retention`` seconds before ``as_of`` are gone."""
    rows = _rows(spark, path, keys, order, ignore_nulls)
    if rows is None or as_of is None:
        return rows
    return within_retention(rows, as_of, time or order[0], retention)


def expire(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], as_of_us: int, *,
           ignore_nulls: bool = False, retention: int = 300, time: str | None = None) -> None:
    """Remove the rows last written more than ``retention`` seconds before ``as_of_us`` (microseconds) from storage.

    A view of whole rows loses the slots that lie wholly before that time, by
    their partitions, unread; the row of a key that is still alive lies in a
    later slot.  Registers of a key that is still alive may be older than the
    key, so the buckets are folded first, and the keys that are too old leave
    with the fold; its parts go at the next call.  Run it beside the stream.
    """
    oldest = as_of_us - retention * 1_000_000
    name = keyed.open_table(spark, path)
    if name is None:
        return
    if not ignore_nulls:
        slot = oldest // (retention * 1_000_000)
        keyed.drop_parts(spark, path, [p for p in keyed.parts(spark, path) if p["slot"] < slot])
        return
    time = time or order[0]
    column = _row_time(time, True)
    table = spark.table(name).select(column.alias(time))
    keyed.compact(spark, path, keys, order, forget=_us(column, table, time) < oldest, least=1, merge=_merge(None))


def fresh_view(spark: SparkSession, path: str, recreate: bool) -> str:
    """Path of the view's data: a new folder when it is recreated on job start."""
    from ..session import new_folder

    return new_folder(spark, "view") if recreate else path
