"""Schemas of the records, and Avro schema text to Spark types."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Field names and types of the wire and table formats.
SENSOR_COLUMNS = [f"sensor_{i}" for i in range(12)]

READING_WIRE = T.StructType(
    [T.StructField("sensor_id", T.IntegerType()), T.StructField("sensor_ts", T.LongType()),
     T.StructField("is_healthy", T.IntegerType()),
     T.StructField("response", T.StructType([T.StructField("result", T.IntegerType())]))]
    + [T.StructField(c, T.IntegerType()) for c in SENSOR_COLUMNS]
)

READING_ENHANCED = T.StructType(
    READING_WIRE.fields
    + [T.StructField("city", T.StringType()), T.StructField("lat", T.DoubleType()),
       T.StructField("lon", T.DoubleType())]
)

READING_TABLE = T.StructType(
    [T.StructField("sensor_id", T.IntegerType()), T.StructField("sensor_ts", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in SENSOR_COLUMNS]
    + [T.StructField("is_healthy", T.IntegerType())]
)

# Readings with the place they come from, as stored.
READING_ENHANCED_TABLE = T.StructType(READING_TABLE.fields + READING_ENHANCED.fields[-3:])

TRANSACTION_RAW = "ts string, account_id string, transaction_id string, amount int, lat double, lon double"
TRANSACTION_TABLE = (
    "ts string, acc_id string, transaction_id string, amount bigint, lat double, lon double, fraud_score double"
)
FRAUD_COLUMNS = [
    "event_time", "diff_ms", "account_id", "txn1_id", "txn2_id", "amount", "lat", "lon", "lat1", "lon1",
    "distance", "f_name", "l_name", "email", "card", "gender", "phone",
]
FRAUD_TABLE_COLUMNS = [
    "event_time", "acc_id", "transaction_id", "f_name", "l_name", "email", "gender", "phone", "card",
    "lat", "lon", "amount",
]
TRAINING_FRAME = T.StructType(
    [T.StructField(str(i), T.DoubleType()) for i in range(12)] + [T.StructField("12", T.IntegerType())]
)
TOPIC_RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "headers array<struct<key:string,value:binary>>"
)
CHANGE_ROW = "id bigint, name string"

# Key columns of the stored tables.
TABLE_KEYS = {
    "sensors": ["sensor_id", "sensor_ts"],
    "transactions": ["ts", "acc_id"],
    "customers": ["acc_id"],
    "fraudulent_txn": ["event_time", "acc_id"],
}
HASH_PARTITIONS = 16

_AVRO_TO_SPARK = {
    "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "string": T.StringType(), "bytes": T.BinaryType(), "boolean": T.BooleanType(),
}
_SPARK_TO_AVRO = {t.typeName(): name for name, t in _AVRO_TO_SPARK.items()}


def _from_avro_type(avro) -> T.DataType:
    if isinstance(avro, list):  # a union; null only makes the field nullable
        return _from_avro_type(next(a for a in avro if a != "null"))
    if isinstance(avro, str):
        return _AVRO_TO_SPARK[avro]
    if avro["type"] == "record":
        return T.StructType([T.StructField(f["name"], _from_avro_type(f["type"])) for f in avro["fields"]])
    if avro["type"] == "array":
        return T.ArrayType(_from_avro_type(avro["items"]))
    if avro.get("logicalType") in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    return _from_avro_type(avro["type"])


def avsc_to_struct(text: str) -> T.StructType:
    """Spark schema of an Avro record schema given as JSON text."""
    return _from_avro_type(json.loads(text))


def _to_avro_type(dtype: T.DataType, name: str):
    if isinstance(dtype, T.StructType):
        return {"type": "record", "name": name,
                "fields": [{"name": f.name, "type": _to_avro_type(f.dataType, f.name)} for f in dtype]}
    return _SPARK_TO_AVRO[dtype.typeName()]


def struct_to_avsc(schema: T.StructType, name: str) -> str:
    """Avro schema text of a Spark schema."""
    return json.dumps(_to_avro_type(schema, name), indent=1)
