"""Tables by name: definition, lookup and life cycle."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import readers, records


def register_stream_table(
    spark: SparkSession,
    name: str,
    provider: str | dict,
    topic: str,
    schema: str | T.StructType,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    event_time: Column | None = None,
    rowtime_column: str = "event_time",
    watermark_seconds: int = 3,
    start: str = "latest",
    stream: bool = True,
    format: str = "json",
) -> DataFrame:
    """Topic as a table: read, decode, transform, event time, watermark, view.

    Without ``event_time`` the record's broker timestamp is the row time.
    """
    source = readers.read_topic(spark, provider, topic, start=start, stream=stream)
    if format == "json":
        rows = records.parse_json_flat(source, schema, keep=["timestamp"])
    elif format == "avro":
        from pyspark.sql.avro.functions import from_avro
        from .schemas import struct_to_avsc

        avsc = struct_to_avsc(records.as_struct(schema), topic)
        rows = source.select("timestamp", from_avro("value", avsc).alias("data")).select("timestamp", "data.*")
    else:
        raise ValueError(f"unknown format {format}")
    return register_rows(rows, name, transform=transform, event_time=event_time, broker_time="timestamp",
                         rowtime_column=rowtime_column, watermark_seconds=watermark_seconds)


def register_rows(rows: DataFrame, name: str, *, transform=None, event_time: Column | None = None,
                  broker_time: str = "timestamp", rowtime_column: str = "event_time",
                  watermark_seconds: int = 3) -> DataFrame:
    """Last steps of :func:`register_stream_table`, for rows that are already decoded."""
    if transform:
        rows = transform(rows)
    rows = rows.withColumn(rowtime_column, event_time if event_time is not None else F.col(broker_time))
    if rows.isStreaming:
        rows = rows.withWatermark(rowtime_column, f"{watermark_seconds} seconds")
    if broker_time in rows.columns and broker_time != rowtime_column:
        rows = rows.drop(broker_time)
    rows.createOrReplaceTempView(name)
    return rows


def register_catalog(spark: SparkSession, tables: Mapping[str, tuple[str | T.StructType, str]], *,
                     table_filter: str = ".*", fmt: str = "parquet") -> list[str]:
    """A view per listed ``name -> (schema, folder)`` whose name matches the filter from end to end."""
    import re

    chosen = sorted(n for n in tables if re.fullmatch(table_filter, n))
    for name in chosen:
        schema, path = tables[name]
        readers.read_folder(spark, path, schema, fmt).createOrReplaceTempView(name)
    return chosen


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """Columns and properties of a table."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def list_tables(spark: SparkSession, pattern: str = "*") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table and a view of that name, if there are any."""
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: str | T.StructType, path: str, *, buckets: int | None = None,
                 bucket_by: list[str] | None = None) -> None:
    """Empty parquet table below ``path``, kept if it already exists."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.as_struct(schema))
    cluster = f"CLUSTERED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {cluster} LOCATION '{path}'")


def replace_rows(df: DataFrame, path: str) -> None:
    """Clear a dimension folder and write the given rows."""
    df.write.mode("overwrite").parquet(path)
