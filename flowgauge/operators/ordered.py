"""Operators that depend on the order of rows inside a key.

One key may hold a large share of all rows, so a plain window over the key
would sort that share in a single task.  Here the rows of a *hot* key (more
than ``hot_rows`` rows) are cut into time cells of that key; each cell is
ordered on its own, and what came before it is added from a table of cell
totals.  Results equal the plain window for any cut.

The hot keys are found with a pre-aggregated pass over the key and time
columns; the few rows it gives are written to the shared folder.  Without a hot
key the plain window follows.  There are fewer than ``rows / hot_rows`` hot
keys with some ``CELLS_PER_HOT_SHARE`` cells for each ``hot_rows`` rows, and
both tables are counted before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.epoch import epoch_us, floor_div
from ..session import broadcast_if_small, written

HOT_ROWS = 5_000_000
CELLS_PER_HOT_SHARE = 8
# A cell that is still too full is cut again; one with a single time is cut by id.
CELLS_PER_CUT = 1 << 20
_TEXT_BYTES = 7  # of an id that stands as text, those that a cut takes as a number
_NO_TIME = -(1 << 61)  # rows without a time come first


def _same(keys: Sequence[str]) -> Column:
    """Key equal to its prefixed copy on the other side, null to null."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def _prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_{k}" for k in keys})


def with_cells(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Add ``_cell``: empty for ordinary keys, else numbers that rise with the order of the key's rows.

    ``order`` starts with a bigint time; a second column of numbers or text is
    used to cut rows of one time.  Cells are cut until none is too full that
    has two different rows.  ``_hot`` marks the rows of hot keys.  ``None``
    where no key is hot, or where the caller knows that (no ``hot_rows``).
    """
    if hot_rows is None:
        return None
    rows = df.withColumns({"_cell": F.array().cast("array<bigint>"), "_full": F.lit(True)})
    for cut in count():
        groups = [*keys, "_cell"]
        full, found = broadcast_if_small(written(_full_groups(rows, groups, order, hot_rows), "hot-groups"))
        if not found:
            break
        rows = _cut(rows, full, groups, order)
        if cut == 0:
            rows = rows.withColumn("_hot", F.col("_full"))
    return rows.drop("_full") if "_hot" in rows.columns else None


def _time_and_id(rows: DataFrame, order: Sequence[str]) -> tuple[Column, Column]:
    """The time, and what cuts rows of one time: a number, or the bytes of a text."""
    time = F.coalesce(F.col(order[0]), F.lit(_NO_TIME))
    kind = dict(rows.dtypes)[order[1]] if len(order) > 1 else ""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return time, F.coalesce(F.col(order[1]).cast("bigint"), F.lit(_NO_TIME))
    if kind == "string":
        return time, F.coalesce(F.col(order[1]), F.lit("")).cast("binary")
    return time, time


def _bytes_as_number(text: Column, skip: Column) -> Column:
    """The bytes after the first ``skip`` as a number that rises with them."""
    digits = F.rpad(F.hex(F.substring(text, skip + 1, F.lit(_TEXT_BYTES))), 2 * _TEXT_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def _shared_bytes(a: Column, b: Column) -> Column:
    """How many first bytes two texts share."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(F.octet_length(a), F.octet_length(b)), F.lit(1))), F.lit(0),
        lambda n, i: F.when((n == i - 1) & (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
                            & (F.octet_length(a) >= i) & (F.octet_length(b) >= i), i).otherwise(n))


def _full_groups(rows: DataFrame, groups: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Groups of more than ``hot_rows`` rows, and how to cut them into parts of equal width in time (or id)."""
    time, ident = _time_and_id(rows, order)
    full = (
        rows.filter("_full").groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(time).alias("_t0"), F.max(time).alias("_t1"),
             F.min(ident).alias("_n0"), F.max(ident).alias("_n1"))
        .filter((F.col("_rows") > hot_rows) & ((F.col("_t0") < F.col("_t1")) | (F.col("_n0") < F.col("_n1"))))
        .withColumn("_skip", F.lit(0))
    )
    if dict(full.dtypes)["_n0"] == "binary":
        full = full.withColumn("_skip", _shared_bytes(F.col("_n0"), F.col("_n1")))
        full = full.withColumns({n: _bytes_as_number(F.col(n), F.col("_skip")) for n in ("_n0", "_n1")})
    parts = F.least(floor_div(F.col("_rows") * CELLS_PER_HOT_SHARE, hot_rows) + 1, F.lit(CELLS_PER_CUT).cast("bigint"))
    by_time = F.col("_t0") < F.col("_t1")
    low, high = F.when(by_time, F.col("_t0")).otherwise(F.col("_n0")), F.when(by_time, F.col("_t1")).otherwise(F.col("_n1"))
    return _prefixed(full.select(*groups, by_time.alias("_by_time"), "_skip", low.alias("_from"),
                                 (F.call_function("div", high - low, parts) + 1).alias("_width")), groups)


def _cut(rows: DataFrame, full: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    time, ident = _time_and_id(rows, order)
    is_text = rows.select(ident.alias("i")).dtypes[0][1] == "binary"
    number = _bytes_as_number(ident, F.col("_skip")) if is_text else ident
    at = F.when(F.col("_by_time"), time).otherwise(number) - F.col("_from")
    part = F.coalesce(F.call_function("div", at, F.col("_width")), F.lit(0))
    return (
        rows.drop("_full").join(full, _same(groups), "left")
        .withColumns({"_cell": F.when(F.col("_width").isNotNull(), F.array_append("_cell", part)).otherwise(F.col("_cell")),
                      "_full": F.col("_width").isNotNull()})
        .drop("_by_time", "_skip", "_from", "_width", *[f"_{g}" for g in groups])
    )


def _cell_totals_before(rows: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """For cells of hot keys: the total over all earlier cells of the key."""
    cells = rows.filter("_hot").groupBy(*keys, "_cell").agg(total.alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.withColumn("_before", F.sum("_total").over(earlier)).drop("_total")
    return broadcast_if_small(written(_prefixed(before, [*keys, "_cell"]), "cell-totals"))[0]


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, hot_rows: int | None, total: Column) -> DataFrame:
    frame = lambda w: w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = with_cells(df, keys, order, hot_rows)
    if rows is None:
        return df.withColumn(out, total.over(frame(Window.partitionBy(*keys))))
    before = _cell_totals_before(rows, keys, total)
    in_cell = total.over(frame(Window.partitionBy(*keys, "_cell")))
    return (
        rows.join(before, _same([*keys, "_cell"]), "left")
        .withColumn(out, in_cell + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_before", "_hot", "_cell", "__cell", *[f"_{k}" for k in keys])
    )


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
             hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """1, 2, 3, … inside each key; ``order`` starts with a bigint time and ends with a unique id."""
    return _running(df, keys, order, out, hot_rows, F.count(F.lit(1)))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str = "running_sum", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Sum of ``value`` up to and including each row, inside each key."""
    zeroed = df.withColumn("_value", F.coalesce(F.col(value), F.lit(0)))
    return _running(zeroed, keys, order, out, hot_rows, F.sum("_value")).drop("_value")


def count_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int = 3,
                  carry: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every ``size`` rows of a key as one window; an incomplete last window is left out.

    Gives the sum of ``value``, and the row with the largest value (the first
    such row on ties) in ``max_value`` and ``max_<column>`` for ``carry``.
    """
    numbered = position(df, keys, order, "_position", hot_rows)
    return fold_count_windows(numbered, keys, value, size, carry)


def _places(value: str, fields: Sequence[str], size: int) -> tuple[list[Column], Column]:
    """Aggregates that pick the row of each place in a window, and the rows as structs that sort by value, then place.

    One aggregate per place: plain values, so Spark aggregates by hash.
    """
    place = F.pmod(F.col("_position") - 1, F.lit(size).cast("bigint"))
    picks = [F.max(F.when(place == i, F.col(c))).alias(f"_{i}_{c}") for i in range(size) for c in fields]
    rows = F.array(*[
        F.struct(F.col(f"_{i}_{value}").alias(value), F.lit(-i).alias("_place"),
                 *[F.col(f"_{i}_{c}").alias(c) for c in fields[1:]])
        for i in range(size)])
    return picks, rows


def fold_count_windows(numbered: DataFrame, keys: Sequence[str], value: str, size: int,
                       carry: Sequence[str]) -> DataFrame:
    """Windows of :func:`count_windows` from rows that carry their ``_position``."""
    fields = [value, *[c for c in carry if c != value]]
    if size <= 16:
        return closed_windows(window_parts(numbered, keys, value, size, carry), keys, value, size, carry)
    best = F.max_by(F.struct(*fields), F.struct(F.col(value), -F.col("_position"))).alias("_best")
    windows = (
        numbered.groupBy(*keys, _window_no(size))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("sum_value"), best)
        .filter(F.col("_n") == size)
    )
    return _best_row(windows, keys, value, carry)


def _window_no(size: int) -> Column:
    return F.call_function("div", F.col("_position") - 1, F.lit(size).cast("bigint")).alias("window_no")


def _best_row(windows: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str]) -> DataFrame:
    return windows.select(*keys, "window_no", "sum_value", F.col(f"_best.{value}").alias("max_value"),
                          *[F.col(f"_best.{c}").alias(f"max_{c}") for c in carry])


def window_parts(numbered: DataFrame, keys: Sequence[str], value: str, size: int, carry: Sequence[str]) -> DataFrame:
    """``window_no, _n, sum_value, _rows`` of every window of a key, the incomplete last one included."""
    fields = [value, *[c for c in carry if c != value]]
    if size <= 16:
        picks, rows = _places(value, fields, size)
        rows = F.slice(rows, 1, F.col("_n").cast("int"))  # the places of a window fill from the first
    else:
        row = F.struct(F.col("_position"), *fields)
        picks = [F.sort_array(F.collect_list(row)).alias("_picked")]
        rows = F.transform("_picked", lambda r: F.struct(
            r[value].alias(value), (-r["_position"]).alias("_place"), *[r[c].alias(c) for c in fields[1:]]))
    return (
        numbered.groupBy(*keys, _window_no(size))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("sum_value"), *picks)
        .select(*keys, "window_no", "_n", "sum_value", rows.alias("_rows"))
    )


def closed_windows(parts: DataFrame, keys: Sequence[str], value: str, size: int, carry: Sequence[str]) -> DataFrame:
    """The complete ones of :func:`window_parts`."""
    return _best_row(parts.filter(F.col("_n") == size).withColumn("_best", F.array_max("_rows")), keys, value, carry)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   keep: Sequence[str] | None = None) -> DataFrame:
    """The last row of each key; each map task sends at most one row per key."""
    rest = [c for c in (keep or df.columns) if c not in keys]
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in rest])


def gaps_and_ends(df: DataFrame, keys: Sequence[str] = (), time: str = "event_time", threshold: int = 45,
                  cells_per_chunk: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Gaps of :func:`inactivity_gaps`, and the first and last time of each key in microseconds."""
    us = epoch_us(time)
    step = threshold * 1_000_000
    cell = floor_div(us, step)
    cells = (
        df.filter(F.col(time).isNotNull()).groupBy(*keys, cell.alias("_c"))
        .agg(F.min(us).alias("_first"), F.max(us).alias("_last"))
        .withColumn("_chunk", floor_div("_c", cells_per_chunk))
    )
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("_c")
    cells = cells.withColumn("_previous", F.lag("_last").over(in_chunk))
    chunks = cells.groupBy(*keys, "_chunk").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    ends = chunks.groupBy(*keys).agg(F.min("_first").alias("first"), F.max("_last").alias("last"))
    # One row per chunk of cells_per_chunk * threshold seconds: 172 rows a year at the defaults.
    over_chunks = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_chunk")
    chunks = chunks.withColumn("_previous", F.lag("_last").over(over_chunks))
    steps = cells.select(*keys, "_previous", "_first").unionByName(chunks.select(*keys, "_previous", "_first"))
    gap = F.col("_first") - F.col("_previous")
    return steps.filter(gap > step).select(
        *keys,
        F.timestamp_micros("_previous").alias("inactive_from"),
        F.timestamp_micros("_first").alias("restored_at"),
        gap.alias("gap_us"),
        F.call_function("div", gap, F.lit(step).cast("bigint")).alias("alerts"),
    ), ends


def inactivity_gaps(df: DataFrame, keys: Sequence[str] = (), time: str = "event_time", threshold: int = 45,
                    cells_per_chunk: int = 4096) -> DataFrame:
    """Stretches longer than ``threshold`` seconds without a record, per key or overall.

    Two records in one cell of ``threshold`` seconds are never further apart
    than the threshold, so the rows are first folded to the first and last time
    of each cell.  The order is then taken over cells in chunks, and over the
    chunks' ends; nothing depends on a single task seeing all rows.

    ``alerts`` is how often a monitor that repeats its message fires in a gap.
    """
    return gaps_and_ends(df, keys, time, threshold, cells_per_chunk)[0]


def open_gap(df: DataFrame, as_of: Column, keys: Sequence[str] = (), time: str = "event_time",
             threshold: int = 45) -> DataFrame:
    """Keys (or the whole input) silent for longer than ``threshold`` seconds at ``as_of``."""
    last = df.groupBy(*keys).agg(F.max(F.col(time).cast("timestamp")).alias("last_seen"))
    silent = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("last_seen")
    return last.withColumn("silent_us", silent).filter(F.col("silent_us") > threshold * 1_000_000)

