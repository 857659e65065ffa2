"""Opening topics, files and tables, as batches or streams.

A *provider* is a dict of reader settings kept once and used by name.  With
``type = "kafka"`` the topic is read from brokers (the connector jar must be on
the class path); with ``type = "files"`` it is read from a folder of parquet
files that hold the same columns as a Kafka record.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import schemas

_providers: dict[str, dict] = {}


def create_provider(name: str, kind: str, **options) -> None:
    _providers[name] = {"type": kind, **options}


def get_provider(name: str) -> dict:
    return _providers[name]


def drop_provider(name: str) -> None:
    _providers.pop(name, None)


def list_providers() -> list[str]:
    return sorted(_providers)


def topic_pattern(filter_text: str) -> str:
    """A topic filter with ``#`` (rest of the path) and ``+`` (one level) as a regex."""
    special = set(r".^$*?{}[]\|()")
    return "".join(
        ".*" if c == "#" else "[^/]+" if c == "+" else f"\\{c}" if c in special else c for c in filter_text
    )


def kafka_options(provider: dict, topic: str, *, pattern: bool = False, start: str = "latest",
                  headers: bool = True, max_per_batch: int | None = None) -> dict[str, str]:
    """Reader options for a Kafka topic; ``start`` is earliest, latest, JSON of offsets, or a time in UTC."""
    options = {f"kafka.{k}": str(v) for k, v in provider.items() if k not in ("type", "path")}
    options["subscribePattern" if pattern else "subscribe"] = topic
    if start in ("earliest", "latest") or start.startswith("{"):
        options["startingOffsets"] = start
    else:
        moment = datetime.fromisoformat(start)
        moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        options["startingTimestamp"] = str(round(moment.timestamp() * 1000))
    options["includeHeaders"] = str(headers).lower()
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_topic(spark: SparkSession, provider: str | dict, topic: str, *, pattern: bool = False,
               start: str = "latest", stream: bool = True, max_per_batch: int | None = None) -> DataFrame:
    """Records of a topic (or of all topics matching a pattern) in Kafka's columns.

    A batch cannot start at the latest offset: name another start for it.

    For file providers ``start`` may also be a timestamp text: only files
    modified since then are read, and ``latest`` stands for the present moment.
    A job that is to be resumed passes the moment of its first start, so that
    files that came while it was stopped are not taken for old ones.
    """
    settings = get_provider(provider) if isinstance(provider, str) else provider
    reader = spark.readStream if stream else spark.read
    if settings["type"] == "kafka":
        return reader.format("kafka").options(
            **kafka_options(settings, topic, pattern=pattern, start=start,
                            max_per_batch=max_per_batch if stream else None)).load()
    reader = reader.schema(schemas.TOPIC_RECORD)
    if stream and max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    records = reader.parquet(settings["path"])
    if start != "earliest" and (stream or start != "latest"):
        since = now_text(spark) if start == "latest" else start
        records = records.filter(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
    return records.filter(topic_matches("topic", topic if pattern else None, None if pattern else topic))


def now_text(spark: SparkSession) -> str:
    return spark.sql("SELECT CAST(current_timestamp() AS string)").first()[0]


def topic_matches(column: str, pattern: str | None, name: str | None = None) -> Column:
    """Topic equal to a name, or matching a regex from end to end."""
    return F.col(column) == name if name is not None else F.col(column).rlike(f"^(?:{pattern})$")


def start_at(records: DataFrame, start: str | None) -> DataFrame:
    """Records with a broker timestamp at or after ``start`` (``None``: from the beginning)."""
    if start is None or start == "earliest":
        return records
    return records.filter(F.col("timestamp") >= F.lit(start).cast("timestamp"))


def read_folder(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet", *,
                stream: bool = False, max_files: int | None = None, **options) -> DataFrame:
    """Files of a known schema in a folder, as a batch or as a stream of arriving files."""
    reader = (spark.readStream if stream else spark.read).schema(schema).format(fmt).options(**options)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, stream: bool = False) -> DataFrame:
    return read_folder(spark, path, schema, "csv", stream=stream)


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text files, one record per line, in column ``value``."""
    return (spark.readStream if stream else spark.read).text(path)


def jdbc_options(url: str, table: str, driver: str, user: str | None = None, password: str | None = None,
                 *, partition_column: str | None = None, lower=None, upper=None,
                 partitions: int | None = None) -> dict[str, str]:
    """Reader or writer options for a database table; a partition column makes the read parallel."""
    if partition_column and None in (lower, upper, partitions):
        raise ValueError("a partition column needs its bounds and a number of partitions")
    options = {"url": url, "dbtable": table, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, small: bool = False, **kwargs) -> DataFrame:
    """A database table; one read by a single task must be named ``small``."""
    if not small and not kwargs.get("partition_column"):
        raise ValueError("name a partition column, or say that the table is small")
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
