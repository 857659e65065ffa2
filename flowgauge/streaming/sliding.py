"""Sliding windows of a keyed stream without a state row for each window.

A window holds the same cells (key and slide) as the window before it unless a
cell enters or leaves, so at most two runs of equal windows follow from a cell.
The state holds the cells whose windows are still open, by group of keys and
time; runs are given out once the watermark has passed them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StringType

from ..functions.epoch import epoch_us, floor_div

# Fixed value: state lies by group, so a job goes on only with the number of groups it began with.
GROUPS = 256
BLOCK_SIZES = 20  # the windows of a key are dealt to the groups in blocks of so many sizes
FOLD_ROWS = 500_000  # rows of a group that wait to be folded to cells
PANDAS_YEARS = 1678, 2262
PIECE_CELLS = 1_000_000  # cells that are spread over their runs at once

WHOLE = (ByteType, ShortType, IntegerType)
HOW = {"_count": np.add, "_sum": np.add, "_fsum": np.add, "_present": np.add, "_min": np.minimum, "_max": np.maximum,
       "_over": np.add}


def fits(keys: Sequence[DataType], value: DataType) -> bool:
    """Whether all of these pass through pandas unchanged (NaN would not), and sums cannot overflow."""
    return bool(keys) and isinstance(value, WHOLE) and all(
        isinstance(k, (*WHOLE, LongType, StringType)) for k in keys)


def window_runs(df: DataFrame, keys: Sequence[str], value: str, time: str, slide: str, step: int, slides: int,
                threshold: float) -> DataFrame:
    """Keys, the ends (``_first`` to ``_last``, in slides) of equal windows, and what their cells recombine to."""
    kinds = [df.schema[k].dataType for k in keys]
    v, kind = F.col(value), df.schema[value].dataType
    block = slides * BLOCK_SIZES
    none = lambda k, t: F.coalesce(F.col(k), F.lit("" if isinstance(t, StringType) else 0).cast(t))
    names = [name for i in range(len(keys)) for name in (f"_key{i}", f"_null{i}")]
    # Rows are late by the end of their cell, as in a windowed aggregate.
    rows = df.select(
        *[c for i, (k, t) in enumerate(zip(keys, kinds))
          for c in (none(k, t).alias(f"_key{i}"), F.col(k).isNull().alias(f"_null{i}"))],
        F.window(time, slide).alias("_slide"), F.coalesce(v, F.lit(0).cast(kind)).alias("_value"),
        F.coalesce(v.cast("float").cast("double"), F.lit(0.0)).alias("_float"), v.isNotNull().alias("_has"), F.coalesce(v > threshold, F.lit(False)).alias("_above"))
    rows = rows.withColumn("_at", F.window_time("_slide")).drop("_slide").withColumn(
        "_cell", floor_div(epoch_us("_at"), step * 1_000_000))
    # The time is only held against the watermark; pandas has none outside these years.
    low, high = (F.lit(f"{year}-01-01 00:00:00").cast("timestamp") for year in PANDAS_YEARS)
    inside = F.least(F.greatest(F.col("_at"), low), high)
    rows = rows.select(*[c for c in rows.columns if c != "_at"], inside.alias("_at", metadata=rows.schema["_at"].metadata))
    blocks = F.sequence(floor_div(F.col("_cell") + 1, block), floor_div(F.col("_cell") + slides, block))
    rows = rows.withColumn("_block", F.explode(blocks)).withColumn(
        "_group", F.pmod(F.hash(*names, "_block"), F.lit(GROUPS)))

    stats = {"_count": "bigint", "_sum": "bigint", "_fsum": "double", "_present": "bigint",
             "_min": kind.simpleString(), "_max": kind.simpleString(), "_over": "bigint"}
    schema = ", ".join([f"_key{i} {t.simpleString()}, _null{i} boolean" for i, t in enumerate(kinds)]
                       + ["_first bigint, _last bigint"] + [f"{s} {t}" for s, t in stats.items()])
    runs = rows.groupBy("_group").applyInPandasWithState(
        _group_runs(names, slides, block, step * 1000), schema, "until bigint, cells binary", "append",
        "EventTimeTimeout")
    present = F.col("_present") > 0
    return runs.select(
        *[F.when(~F.col(f"_null{i}"), F.col(f"_key{i}")).alias(k) for i, k in enumerate(keys)], "_first", "_last",
        "_count", "_fsum", "_present", "_over", *[F.when(present, F.col(s)).alias(s) for s in ("_sum", "_min", "_max")])


def _group_runs(names: Sequence[str], slides: int, block: int, step_ms: int):
    """For ``applyInPandasWithState``: the runs of a group that have closed; its state keeps the cells of the others."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        after, cells, waiting = None, [], 0
        if state.exists:
            after, held = state.get
            cells = [pa.ipc.open_stream(held).read_pandas()]
        for batch in batches:
            if len(batch):
                cells.append(_cells(batch, names))
                waiting += len(batch)
            if waiting > FOLD_ROWS:
                cells, waiting = [_folded(pd.concat(cells, ignore_index=True), names)], 0
        if not cells:
            return
        held = _folded(pd.concat(cells, ignore_index=True), names)
        until = state.getCurrentWatermarkMs() // step_ms
        yield from _runs(held, names, slides, block, after, until)

        begin = held["_block"].to_numpy() * block
        ends = np.minimum(held["_cell"].to_numpy() + slides, begin + block - 1)
        opens = np.maximum(np.maximum(held["_cell"].to_numpy() + 1, begin), until + 1)
        still = ends > until
        if still.any():
            table = pa.Table.from_pandas(held[still], preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            state.update((until, sink.getvalue().to_pybytes()))
            # A group is due once the watermark is past this moment, so at the end of its next window.
            state.setTimeoutTimestamp(int(opens[still].min()) * step_ms - 1)
        elif state.exists:
            state.remove()
    return run


def _cells(rows: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    value, has = rows["_value"].to_numpy(), rows["_has"].to_numpy()
    ends = np.iinfo(value.dtype)
    single = rows[[*names, "_block", "_cell"]].assign(
        _count=1, _sum=value.astype("int64"), _fsum=rows["_float"].to_numpy(),
        _present=has.astype("int64"), _min=np.where(has, value, value.dtype.type(ends.max)),
        _max=np.where(has, value, value.dtype.type(ends.min)), _over=rows["_above"].to_numpy().astype("int64"))
    return _folded(single, names)


def _codes(cells: pd.DataFrame, names: Sequence[str]) -> np.ndarray:
    return cells.groupby([*names, "_block"], sort=False).ngroup().to_numpy()


def _folded(cells: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    """One row for each key, block and cell, in that order."""
    code, cell = _codes(cells, names), cells["_cell"].to_numpy()
    order = np.lexsort((cell, code))
    code, cell = code[order], cell[order]
    starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (cell[1:] != cell[:-1])])
    out = cells[[*names, "_block", "_cell"]].iloc[order[starts]].reset_index(drop=True)
    return out.assign(**{s: how.reduceat(cells[s].to_numpy()[order], starts) for s, how in HOW.items()})


def _runs(cells: pd.DataFrame, names: Sequence[str], slides: int, block: int, after: int | None,
          until: int) -> Iterator[pd.DataFrame]:
    """The runs of windows with an end above ``after``, up to ``until`` and inside the block, that hold a cell."""
    code, cell = _codes(cells, names), cells["_cell"].to_numpy()
    low = cells["_block"].to_numpy() * block - slides
    width = block + 3 * slides + 2
    place = code * width + (cell - low)  # keys and blocks lie further apart than a window is long
    edges = np.unique(np.concatenate([place + 1, place + slides + 1]))
    first, last = edges[:-1], edges[1:] - 1
    a, b = np.searchsorted(place, first - slides), np.searchsorted(place, first)
    some = b > a
    first, last, a, b = first[some], last[some], a[some], b[some]
    shift, begin = low[a] - code[a] * width, low[a] + slides
    first = np.maximum(first + shift, begin if after is None else np.maximum(begin, after + 1))
    last = np.minimum(last + shift, np.minimum(begin + block - 1, until))
    some = first <= last
    first, last, a, b = first[some], last[some], a[some], b[some]
    sizes = b - a
    ends = np.cumsum(sizes)
    i = 0
    while i < len(a):
        done = ends[i] - sizes[i]
        j = max(i + 1, int(np.searchsorted(ends, done + PIECE_CELLS, side="right")))
        starts = ends[i:j] - sizes[i:j] - done
        of = np.repeat(a[i:j] - starts, sizes[i:j]) + np.arange(ends[j - 1] - done)
        out = cells[list(names)].iloc[a[i:j]].reset_index(drop=True).assign(_first=first[i:j], _last=last[i:j])
        yield out.assign(**{s: how.reduceat(cells[s].to_numpy()[of], starts) for s, how in HOW.items()})
        i = j
