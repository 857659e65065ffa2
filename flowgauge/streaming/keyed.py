"""Keyed tables: upserts by key, read as the last row per key.

A keyed table is a Spark table: clustered by its key into hash buckets, and partitioned by (bucket,
version, slot).  Micro-batch ``n`` adds version ``2 n`` to the buckets its keys fall into and to no
other; a repeated batch overwrites its own partitions, so the result is the same after a restart.
Since Spark knows the buckets, the fold to the last row of each key, and a join on the key, read the
table without a shuffle; and a reader that knows its buckets scans only those.

:func:`compact` folds buckets with several versions into version ``2 n + 1``.  It is meant to run
beside the stream, not inside a micro-batch: it leaves the newest batch alone, which may have to be
repeated, and what it has folded stays for readers that are under way until the next time.  Folding
is associative, so a reader that meets both the folded rows and their parts gets the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ordered import latest_per_key
from ..sources.schemas import HASH_PARTITIONS

OWN = ["bucket", "version", "slot"]
Merge = Callable[[DataFrame, Sequence[str]], DataFrame]


def _name(path: str) -> str:
    return "keyed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _create(spark: SparkSession, path: str, columns: T.StructType, keys: Sequence[str], buckets: int) -> str:
    name = _name(path)
    clustered = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}, bucket INT, version BIGINT, slot BIGINT) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (bucket, version, slot) "
        f"CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{path}/rows'")
    return name


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int] | None:
    """Key columns and number of buckets that the table was made with."""
    try:
        row = spark.read.schema("keys array<string>, buckets int").json(f"{path}/layout").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (row["keys"], row["buckets"]) if row else None


def _buckets(spark: SparkSession, name: str) -> int:
    return next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect() if r["col_name"] == "Num Buckets")


def open_table(spark: SparkSession, path: str, refresh: bool = True) -> str | None:
    """Name of the Spark table that holds a keyed table; ``None`` before the first write.

    A reader takes note of what other sessions have written.  That also drops
    what is cached of the table, so a writer, whose rows may come from such a
    cache, goes without.
    """
    name = _name(path)
    if not spark.catalog.tableExists(name):
        layout = _layout(spark, path)
        if layout is None:
            return None
        try:
            found = spark.read.option("mergeSchema", "true").parquet(f"{path}/rows").schema
        except AnalysisException as error:  # made, but only empty batches so far
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        _create(spark, path, T.StructType([f for f in found if f.name not in OWN]), *layout)
        spark.sql(f"MSCK REPAIR TABLE {name}")
    if refresh:
        spark.catalog.refreshTable(name)
    return name


def parts(spark: SparkSession, path: str) -> list[dict[str, int]]:
    """Partitions (bucket, version, slot) of the table, from the catalogue: some for each bucket."""
    name = open_table(spark, path)
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect() if name else []
    return [{c: int(v) for c, v in (p.split("=") for p in r["partition"].split("/"))} for r in rows]


def drop_parts(spark: SparkSession, path: str, found: Sequence[dict[str, int]]) -> None:
    """Take partitions out of the table, whole, and delete their files."""
    for begin in range(0, len(found), 500):
        specs = ", ".join("PARTITION (" + ", ".join(f"{c} = {p[c]}" for c in OWN) + ")" for p in found[begin:begin + 500])
        spark.sql(f"ALTER TABLE {_name(path)} DROP IF EXISTS {specs}")
    for p in found:  # the table is external to the catalogue, which leaves the files
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/" + "/".join(f"{c}={p[c]}" for c in OWN))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of the key, as Spark clusters tables."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = HASH_PARTITIONS) -> DataFrame:
    """Hash partition of the key as column ``bucket``."""
    return df.withColumn("bucket", bucket_of(keys, buckets))


def touched(df: DataFrame, keys: Sequence[str], buckets: int = HASH_PARTITIONS) -> list[int]:
    """Buckets of the keys in a batch: at most ``buckets`` numbers."""
    return sorted(r[0] for r in df.select(bucket_of(keys, buckets)).distinct().collect())


def latest(order: Sequence[str]) -> Merge:
    """The fold to the last row of a key by ``order``, and by arrival where that is equal."""
    by = ["version" if c == "batch_id" else c for c in order]
    by += [] if "version" in by else ["version"]
    return lambda rows, keys: latest_per_key(rows, keys, by)


def write_changes(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], order: Sequence[str] = (),
                  buckets: int = HASH_PARTITIONS, unique: bool = False, by: Sequence[Column] = (),
                  slot: Column | None = None) -> None:
    """Add a batch of upserts.

    ``order`` (columns) or ``by`` (expressions) says which of several rows of a
    key in one batch is the last, and is asked for unless the caller knows keys
    to be ``unique`` in the batch.  Rows with a true ``_deleted`` column remove
    their key.  ``slot`` (a number that rises with time) allows to drop old
    rows by whole partitions.  The number of buckets is that of the first write.
    """
    if not unique:
        if not order and not by:
            raise ValueError("order says which row of a key is the last")
        columns = df.columns
        made = {f"_by{i}": c for i, c in enumerate(by)}
        kept = [c for c in [*columns, *made] if c not in keys]
        df = latest_per_key(df.withColumns(made) if made else df, keys, [*made, *order], keep=kept).select(*columns)
    if "_deleted" not in df.columns:
        df = df.withColumn("_deleted", F.lit(False))
    _write(df, path, keys, buckets, F.lit(2 * batch_id).cast("bigint"), F.lit(0) if slot is None else slot)


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, version: Column, slot: Column) -> None:
    spark = df.sparkSession
    name = open_table(spark, path, refresh=False)
    if name is None:
        if _layout(spark, path) is None:
            layout = spark.createDataFrame([(list(keys), buckets)], "keys array<string>, buckets int")
            layout.coalesce(1).write.mode("overwrite").json(f"{path}/layout")
        name = _create(spark, path, T.StructType([f for f in df.schema if f.name not in OWN]), *_layout(spark, path))
    buckets = _buckets(spark, name)
    known = {f.name: f for f in spark.table(name).schema if f.name not in OWN}
    added = [f for f in df.schema if f.name not in known and f.name not in OWN]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({T.StructType(added).toDDL()})")
    columns = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(f.dataType).alias(c) for c, f in known.items()]
    # Keys are unique now, so the buckets are of even size; each is one task and one file.
    (df.repartition(buckets, *keys)
     .select(*columns, *[F.col(f"`{f.name}`") for f in added], bucket_of(keys, buckets), version, slot.cast("bigint"))
     .write.insertInto(name, overwrite=True))


def read_all(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",),
             before: int | None = None, only: Sequence[int] | None = None, merge: Merge | None = None) -> DataFrame | None:
    """Last row per key with ``_deleted``, ``bucket``, ``version`` and ``slot``.

    ``before`` takes only batches below that number, ``only`` only those buckets.
    The scan is bucketed, so that the fold needs no shuffle.
    """
    name = open_table(spark, path)
    if name is None:
        return None
    rows = spark.table(name)
    if before is not None:
        rows = rows.filter(F.col("version") < 2 * before)
    if only is not None:
        rows = rows.filter(F.col("bucket").isin([int(b) for b in only]))
    return (merge or latest(order))(rows, keys)


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",),
               before: int | None = None, only: Sequence[int] | None = None,
               merge: Merge | None = None) -> DataFrame | None:
    """Current rows of the table; ``None`` before the first write."""
    rows = read_all(spark, path, keys, order, before, only, merge)
    if rows is None:
        return None
    return rows.filter(~F.col("_deleted")).drop("_deleted", *OWN)


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",),
            forget: Column | None = None, least: int = 2, upto: int | None = None, merge: Merge | None = None) -> list[int]:
    """Fold the buckets that have ``least`` versions up to batch ``upto``, and no others; returns their numbers.

    ``upto`` is the last batch but one where not given, so that the newest can
    be repeated.  Deleted keys stay marked, so that an older change arriving
    later does not bring them back, until ``forget`` holds for them; rows that
    are not deleted go as well where it holds.  What an earlier call has folded
    is dropped now.
    """
    found = parts(spark, path)
    newest = max((p["version"] // 2 for p in found), default=-1)
    upto = newest - 1 if upto is None else upto
    folded: dict[int, int] = {}
    for p in found:
        if p["version"] % 2:
            folded[p["bucket"]] = max(folded.get(p["bucket"], -1), p["version"])
    stale = [p for p in found if p["version"] < folded.get(p["bucket"], -1)]
    drop_parts(spark, path, stale)
    count: dict[int, set[int]] = {}
    for p in found:
        if p not in stale and p["version"] <= 2 * upto + 1:
            count.setdefault(p["bucket"], set()).add(p["version"])
    due = sorted(b for b, v in count.items() if len(v) >= least and v != {2 * upto + 1})
    if not due:
        return []
    rows = read_all(spark, path, keys, order, upto + 1, due, merge)
    if forget is not None:  # as the key stands with the newer batches
        whole = read_all(spark, path, keys, order, only=due, merge=merge)
        gone = whole.filter(forget).select(*[F.col(k).alias(f"_{k}") for k in keys])
        rows = rows.join(gone, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    # The new version comes after the batch it goes up to, and before the next one.
    _write(rows, path, keys, 0, F.lit(2 * upto + 1).cast("bigint"), F.col("slot"))
    if forget is not None:  # a bucket with no row left has no fold that would supersede its parts
        left = {p["bucket"] for p in parts(spark, path) if p["version"] == 2 * upto + 1}
        drop_parts(spark, path, [p for p in found if p["bucket"] in due and p["bucket"] not in left
                                 and p["version"] <= 2 * upto + 1 and p not in stale])
    return due


def upsert(path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = HASH_PARTITIONS,
           shape: Callable[[DataFrame], DataFrame] = lambda d: d, unique: bool = False,
           by: Sequence[Column] = ()) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: the last write per key wins, by ``order`` or ``by`` inside a batch."""
    return lambda batch, batch_id: write_changes(shape(batch), path, batch_id, keys, order, buckets, unique, by)
