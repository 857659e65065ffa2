"""Text and JSON functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_bytes(c: Column | str, charset: str = "UTF-8") -> Column:
    return F.decode(_col(c), charset)


def json_value(c: Column | str, path: str, as_type: str = "double") -> Column:
    """Value at a JSON path; missing or unreadable gives null."""
    return F.get_json_object(_col(c), path).try_cast(as_type)


def number_after_name(c: Column | str, name: str) -> Column:
    """Number that follows ``"name":`` in raw text, without parsing the record."""
    pattern = rf'"{name}"\s*:\s*([0-9.]+)'
    return F.regexp_extract(_col(c), pattern, 1).try_cast("double")


def digit_runs(df: DataFrame, column: str, out: str = "run", at_least: int = 10) -> DataFrame:
    """One row per run of at least ``at_least`` digits in a text column."""
    runs = F.regexp_extract_all(F.col(column), F.lit(f"[0-9]{{{at_least},}}"), F.lit(0))
    return df.withColumn(out, F.explode(runs))


def replace_whole(c: Column | str, template: str) -> Column:
    """Replace the whole text, line breaks included, by a template (``$1`` is the old text)."""
    return F.regexp_replace(_col(c), r"(?s)\A(.*)\z", template)


def feature_text(columns: Sequence[str]) -> Column:
    """Features joined as ``a, b, c``, the form a model request takes."""
    return F.concat_ws(", ", *[F.col(c).cast("string") for c in columns])


def feature_numbers(c: Column | str) -> Column:
    """``a, b, c`` back to an array of doubles; a bad entry becomes null."""
    return F.transform(F.split(_col(c), ","), lambda x: F.trim(x).try_cast("double"))


def stub_result(keys: Sequence[str] | None = None, buckets: int = 2, seed: int = 0) -> Column:
    """Stand-in for a model answer: random, or repeatable, in any engine with MD5, when ``keys`` are given."""
    if keys:
        named = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        return (F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
    return F.floor(F.rand(seed) * buckets).cast("int")


def log_axis(c: Column | str) -> Column:
    """Base-10 logarithm for a log axis; null where it is not defined."""
    c = _col(c).cast("double")
    return F.when(c > 0, F.log10(c))


def as_text(c: Column | str) -> Column:
    return _col(c).cast("string")
