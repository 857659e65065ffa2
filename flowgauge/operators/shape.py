"""Projections: pick, flatten, rename, cast, assign, fill, tag."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def flatten(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested fields as plain columns: ``{new name: path}``."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def assign_path(df: DataFrame, target: str, source: str) -> DataFrame:
    """Set one path of the record from another."""
    head, _, rest = target.partition(".")
    value = F.col(source)
    return df.withColumn(head, F.col(head).withField(rest, value) if rest else value)


def insert_record(df: DataFrame, target: str, fields: Mapping[str, Column]) -> DataFrame:
    """Put a record under one column."""
    return df.withColumn(target, F.struct(*[c.alias(n) for n, c in fields.items()]))


def fill_nested(df: DataFrame, path: str, default: Column) -> DataFrame:
    """Default for ``outer.inner`` where the record or the field is missing."""
    outer, inner = path.split(".")
    filled = F.coalesce(F.col(path), default)
    schema = df.schema[outer].dataType
    if not isinstance(schema, T.StructType):
        raise TypeError(f"{outer} is not a record")
    fields = [filled.cast(f.dataType).alias(f.name) if f.name == inner else F.col(f"{outer}.{f.name}")
              for f in schema]
    return df.withColumn(outer, F.struct(*fields))


def tag(df: DataFrame, **constants) -> DataFrame:
    """Constant columns, such as the schema name of every record."""
    return df.withColumns({n.replace("__", "."): F.lit(v) for n, v in constants.items()})


def apply_hooks(df: DataFrame, *hooks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run user transforms one after another."""
    for hook in hooks:
        df = df.transform(hook)
    return df


def insert_columns(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Rows in the shape of an insert with a column list: ``{target: source}``."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
