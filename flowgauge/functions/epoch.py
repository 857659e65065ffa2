"""Epoch numbers and timestamps.

``sensor_ts`` is a bigint in microseconds everywhere; other units are converted
on the way in.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Units per second.
PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c: Column | str, n: int) -> Column:
    """Integer division rounding down; no detour over doubles."""
    c, n = _col(c), F.lit(n).cast("bigint")
    return F.call_function("div", c - F.pmod(c, n), n)


def truncating_div(c: Column | str, n: int) -> Column:
    """Integer division rounding towards zero."""
    return F.call_function("div", _col(c), F.lit(n).cast("bigint"))


def rescale_epoch(c: Column | str, from_unit: str, to_unit: str) -> Column:
    """Epoch in another unit; going coarser rounds half up."""
    a, b = PER_SECOND[from_unit], PER_SECOND[to_unit]
    c = _col(c).cast("bigint")
    if a == b:
        return c
    if a < b:
        return c * F.lit(b // a)
    step = a // b
    return floor_div(c + F.lit(step // 2), step)


def timestamp_from_ms_floored(c: Column | str) -> Column:
    """Milliseconds to a timestamp, whole seconds only."""
    return F.timestamp_seconds(floor_div(_col(c).cast("bigint"), 1000))


def timestamp_from_us(c: Column | str) -> Column:
    """Microseconds to a timestamp, nothing lost."""
    return F.timestamp_micros(_col(c).cast("bigint"))


def text_to_epoch_ms(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Date text to epoch milliseconds in the session zone (UTC); bad text gives null."""
    return F.unix_millis(F.try_to_timestamp(_col(c), F.lit(pattern)))


def epoch_us(c: Column | str) -> Column:
    """Timestamp (with or without zone; the session runs in UTC) to microseconds."""
    return F.unix_micros(_col(c).cast("timestamp"))


def elapsed_ms(later: Column | str, earlier: Column | str) -> Column:
    return _col(later) - _col(earlier)


def shift_time(c: Column | str, amount: str, back: bool = False) -> Column:
    """Timestamp plus (or minus) an interval such as ``'10 minutes'``."""
    step = F.expr(f"INTERVAL '{amount}'")
    return _col(c) - step if back else _col(c) + step


def interval_seconds(text: str) -> int:
    """Seconds in a short interval text such as ``'10 minutes 3 seconds'``."""
    # Seconds per unit.
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    words = text.lower().split()
    return sum(int(n) * size[u.rstrip("s")] for n, u in zip(words[::2], words[1::2]))


def naive(c: Column | str) -> Column:
    """Timestamp without zone, for results that are compared or exported."""
    return _col(c).cast("timestamp_ntz")
