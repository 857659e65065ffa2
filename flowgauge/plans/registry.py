"""Registered queries, and the SQL views of the reference data model they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows if there is one."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def _sensor_sql(i: int) -> str:
    if i == 0:
        return "CAST(floor(value * 2) AS INTEGER)"
    if i in (1, 6):
        return "CAST(floor(value) AS INTEGER)"
    return f"CAST((event_id * {i}) % 100 AS INTEGER)"


SENSORS_SQL = ", ".join(f"{_sensor_sql(i)} AS sensor_{i}" for i in range(12))
SENSOR_LIST = ", ".join(f"sensor_{i}" for i in range(12))

READINGS = f"""readings AS (
  SELECT CAST(user_id AS INTEGER) AS sensor_id, epoch_us(ts) AS sensor_ts, {SENSORS_SQL},
         CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS is_healthy,
         ts AS event_time, event_id AS reading_id
  FROM events)"""

RECORDS = f"""records AS (
  SELECT CAST(user_id AS VARCHAR) AS key, 'iot/' || event_type AS topic, CAST(event_id % 10 AS INTEGER) AS "partition",
         event_id // 10 AS "offset", ts AS "timestamp",
         CASE WHEN event_id % 5 = 0 THEN 'TransactionEvent' ELSE 'SensorReading' END AS schema_name,
         'producer-' || CAST(event_id % 3 AS VARCHAR) AS client_id,
         CAST(user_id AS INTEGER) AS sensor_id, epoch_us(ts) AS sensor_ts,
         CASE WHEN event_id % 7 <> 0 THEN CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END END AS result,
         {SENSORS_SQL}, event_id
  FROM events)"""

# Text of a topic record, written field by field; the response is absent where it has no value.
RECORD_TEXT = (
    """'{"sensor_id":' || sensor_id || ',"sensor_ts":' || sensor_ts || CASE WHEN result IS NULL THEN '' """
    """ELSE ',"response":{"result":' || result || '}' END || """
    + " || ".join(f"""',"sensor_{i}":' || sensor_{i}""" for i in range(12)) + " || '}'"
)

TRANSACTIONS = """transactions AS (
  SELECT epoch_us(ts) // 1000 AS ts, CAST(user_id AS VARCHAR) AS account_id, CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(floor(value) AS INTEGER) AS amount,
         CAST(-37 + (event_id % 10) * 0.5 AS DOUBLE) AS lat, CAST(144 + (event_id % 7) * 0.5 AS DOUBLE) AS lon,
         (event_id % 100) / CAST(100 AS DOUBLE) AS fraud_score, ts AS event_time
  FROM events)"""

CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS acc_id, split_part(c_name, '#', 1) AS f_name, split_part(c_name, '#', 2) AS l_name,
         'c' || c_custkey || '@example.com' AS email, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         '+00' || c_custkey AS phone, c_mktsegment AS card
  FROM customer)"""

CHANGES = """changes AS (
  SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, user_id AS id,
         event_type || '-' || event_id AS name, epoch_us(ts) AS ts, event_id AS seq
  FROM events)"""


def km_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"2 * 6371 * atan2(sqrt({a}), sqrt(greatest(0, 1 - {a})))"


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
