"""Latest-state views and their named queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .ordered import latest_per_key

# URL patterns of the published views and the filter each applies.
VIEW_QUERIES = {
    "above60": "sensorGreaterThan60 > 0",
    "above60withRange/{lowerTemp}/{upperTemp}":
        "sensorGreaterThan60 > 0 AND sensorAverage >= :lowerTemp AND sensorAverage <= :upperTemp",
}


def latest_state(df: DataFrame, keys: Sequence[str], order: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Last state per key; with ``ignore_nulls`` each column keeps its last non-null value."""
    if not ignore_nulls:
        return latest_per_key(df, keys, order)
    fields = [c for c in df.columns if c not in keys]
    return values_of(fold_registers(df, keys, fields, order), keys, fields)


def registers(df: DataFrame, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each field as a register: its value under the order key it was written with, null where the value is null."""
    at = F.struct(*[F.col(f"`{c}`").alias(c) for c in order])
    return df.withColumns({c: F.when(F.col(f"`{c}`").isNotNull(), F.struct(at.alias("at"), F.col(f"`{c}`").alias("value")))
                           for c in fields})


def merge_registers(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last writer of each field.  Any grouping of the rows gives the same.

    Columns in ``newest`` keep their greatest value.
    """
    last = [F.max_by(F.col(f"`{c}`"), F.col(f"`{c}`.at")).alias(c) for c in fields]
    return rows.groupBy(*keys).agg(*last, *[F.max(c).alias(c) for c in newest])


# Types that Spark aggregates in place, without a sort of the rows.
FIXED_WIDTH = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}


def fold_registers(df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[str],
                   newest: Sequence[str] = ()) -> DataFrame:
    """``merge_registers`` of the ``registers`` of the rows.

    Spark sorts all rows to fold registers, which are structs.  Where the order
    is one column and all is of fixed width, the greatest order and its value
    are folded as plain columns instead, and made registers after.
    """
    types = dict(df.dtypes)
    if len(order) > 1 or not all(types[c] in FIXED_WIDTH for c in (*order, *fields)):
        return merge_registers(registers(df, fields, order), keys, fields, newest)
    at = F.col(f"`{order[0]}`")
    folds, made = [], []
    for i, c in enumerate(fields):
        value = F.col(f"`{c}`")
        written = F.when(value.isNotNull(), at)
        folds += [F.max(written).alias(f"_at{i}"), F.max_by(value, written).alias(f"_value{i}"),
                  F.first(F.when(at.isNull(), value), ignorenulls=True).alias(f"_without{i}")]
        register = lambda when, what: F.struct(F.struct(when.alias(order[0])).alias("at"), what.alias("value"))
        first = F.col(f"_at{i}")
        made.append(F.when(first.isNotNull(), register(first, F.col(f"_value{i}"))).when(  # null orders come before all others
            F.col(f"_without{i}").isNotNull(), register(F.lit(None).cast(types[order[0]]), F.col(f"_without{i}"))).alias(c))
    folded = df.groupBy(*keys).agg(*folds, *[F.max(c).alias(c) for c in newest])
    return folded.select(*keys, *made, *newest)


def values_of(rows: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The values that the registers hold."""
    return rows.select(*keys, *[F.col(f"`{c}`.value").alias(c) for c in fields])


def within_retention(df: DataFrame, as_of: Column, time: str, seconds: int = 300) -> DataFrame:
    """Rows no older than the retention; a row of exactly that age is kept."""
    return df.filter(F.col(time) >= as_of - F.make_dt_interval(secs=F.lit(seconds)))


def parse_request(pattern: str, url: str) -> dict[str, float] | None:
    """Parameters of a request path that fits a URL pattern, else ``None``."""
    want, got = pattern.strip("/").split("/"), url.strip("/").split("/")
    if len(want) != len(got):
        return None
    values = {}
    for w, g in zip(want, got):
        if w.startswith("{") and w.endswith("}"):
            values[w[1:-1]] = float(g)
        elif w != g:
            return None
    return values


def query_view(spark: SparkSession, view: str, url: str, queries: Mapping[str, str] = VIEW_QUERIES) -> DataFrame:
    """Rows of a view for a request path such as ``above60withRange/20/80``."""
    for pattern, condition in queries.items():
        values = parse_request(pattern, url)
        if values is not None:
            return spark.sql(f"SELECT * FROM {view} WHERE {condition}", args=values)
    raise KeyError(f"no view query fits {url}")
