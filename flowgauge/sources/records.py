"""Turning record bytes into columns, and setting aside what cannot be read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import decode_bytes


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parse_json(df: DataFrame, schema: str | T.StructType, value: str = "value", out: str = "data",
               keep_text: bool = True) -> DataFrame:
    """Decode a bytes (or text) column and parse it as one JSON object.

    Adds the struct ``out`` (null where the text is no JSON object) and, with
    ``keep_text``, the text in ``decoded``.
    """
    names = [f.name for f in as_struct(schema)]
    marked = T.StructType(as_struct(schema).fields + [T.StructField("_bad", T.StringType())])
    parsed = F.from_json("decoded", marked, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    # The one-element explode keeps Spark from repeating the parse in every later filter and field.
    rows = df.withColumn("decoded", _text(df, value)).withColumn("_parsed", F.explode(F.array(parsed)))
    readable = F.col("_parsed").isNotNull() & F.col("_parsed._bad").isNull()
    record = F.struct(*[F.col(f"_parsed.`{n}`").alias(n) for n in names])
    rows = rows.withColumn(out, F.when(readable, record)).drop("_parsed")
    return rows if keep_text else rows.drop("decoded")


def _text(df: DataFrame, value: str) -> Column:
    return decode_bytes(value) if dict(df.dtypes)[value] == "binary" else F.col(value)


def parse_json_flat(df: DataFrame, schema: str | T.StructType, value: str = "value",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Readable records of :func:`parse_json` as plain columns; :func:`unreadable` has the others."""
    parsed = parse_json(df, schema, value)
    return parsed.filter(F.col("data").isNotNull()).select(*keep, "data.*")


def unreadable(df: DataFrame, schema: str | T.StructType, value: str = "value",
               keep: Sequence[str] = ()) -> DataFrame:
    """Records that :func:`parse_json_flat` leaves out, with their text in ``decoded`` and the ``reason``."""
    parsed = parse_json(df, schema, value).filter(F.col("data").isNull())
    return parsed.select(*keep, "decoded", F.lit("unreadable").alias("reason"))


def parse_json_array(df: DataFrame, schema: str | T.StructType, value: str = "value",
                     out: str = "data") -> tuple[DataFrame, DataFrame]:
    """One row per record of a message that holds a JSON array or a single object.

    The second table has the messages that cannot be read as either, and those
    with a record that cannot, whole, with their text in ``decoded``.
    """
    text = F.trim(_text(df, value))
    # Each element is parsed by itself, as one that cannot be read would void the whole array.
    elements = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), "array<string>")
    read = lambda e: F.from_json(e, as_struct(schema), {"mode": "PERMISSIVE"})
    objects = F.filter(elements, lambda e: e.startswith("{"))
    whole = F.try_parse_json(text).isNotNull() & (F.size(objects) == F.size(elements))
    marked = df.withColumn("decoded", _text(df, value)).withColumn("_parts", F.explode(F.array(F.struct(
        F.coalesce(whole, F.lit(False)).alias("ok"), objects.alias("all")))))
    good = marked.filter("_parts.ok").withColumn(out, F.explode(F.transform("_parts.all", read)))
    bad = marked.filter("NOT _parts.ok").withColumn("reason", F.lit("unreadable"))
    return good.drop("_parts", "decoded"), bad.drop("_parts")


def header_value(name_pattern: str, headers: str = "headers") -> Column:
    """Text of the first header whose name matches a regex, such as ``schema.*``."""
    found = F.filter(F.col(headers), lambda h: h["key"].rlike(f"^(?:{name_pattern})$"))
    return F.get(found, F.lit(0))["value"].cast("string")


def parse_by_schema_name(df: DataFrame, schemas: Mapping[str, str | T.StructType], name: Column,
                         value: str = "value") -> dict[str, DataFrame]:
    """Records split by the schema each one names, parsed with that schema.

    Those that name no known schema stand under ``unmatched``, and those that
    cannot be read with theirs under ``unreadable``, with their text.
    """
    named = df.withColumn("schema_name", name)
    parts = {n: parse_json_flat(named.filter(F.col("schema_name") == n), s, value, keep=["schema_name"])
             for n, s in schemas.items()}
    bad = [unreadable(named.filter(F.col("schema_name") == n), s, value, keep=["schema_name"]) for n, s in schemas.items()]
    parts["unreadable"] = reduce(DataFrame.unionByName, bad)
    known = F.col("schema_name").isin(*schemas)
    parts["unmatched"] = named.filter(~F.coalesce(known, F.lit(False)))
    return parts


def read_as_newest(frames: Sequence[DataFrame]) -> DataFrame:
    """Records of several schema versions under all their columns; a missing field is null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def detect_schema(df: DataFrame, value: str = "value", sample: float = 1.0, seed: int = 1) -> T.StructType:
    """Schema that fits a sample of JSON texts, merged by an aggregate; only the schema reaches the driver."""
    texts = df.select(_text(df, value).alias("v"))
    if sample < 1.0:
        texts = texts.sample(sample, seed)
    found = texts.agg(F.schema_of_variant_agg(F.try_parse_json("v")).alias("s")).first()["s"]
    return _plain_type(T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")))


def _plain_type(dtype: T.DataType) -> T.DataType:
    """Types a JSON reader gives: double for decimals, string where nothing or no one type was seen."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _plain_type(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain_type(dtype.elementType))
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    if isinstance(dtype, (T.NullType, T.VariantType)):
        return T.StringType()
    return dtype


def split_valid_invalid(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass a check, and the rest (a null check counts as failed) for quarantine."""
    ok = F.coalesce(ok, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def split_parsed(parsed: DataFrame, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Output of :func:`parse_json` as readable rows, and the other records with their text and a reason."""
    ok = F.col("data").isNotNull()
    for name in required:
        ok = ok & F.col(f"data.{name}").isNotNull()
    good, bad = split_valid_invalid(parsed, ok)
    reason = F.when(F.col("data").isNull(), F.lit("unreadable")).otherwise(F.lit("missing field"))
    return good.select("data.*"), bad.select("decoded", reason.alias("reason"))


def parse_or_quarantine(df: DataFrame, schema: str | T.StructType, value: str = "value",
                        required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and unreadable records with the text and a reason."""
    return split_parsed(parse_json(df, schema, value), required)
