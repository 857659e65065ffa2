"""Functions known by name in SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# SQL bodies of the built-in named functions: pure expressions, so they stay in codegen.
SQL_FUNCTIONS = {
    "HAVETOKM": (
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE",
        "DOUBLE",
        """12742.0D * atan2(
             sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
                  + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)),
             sqrt(greatest(0D, 1 - (pow(sin(radians(lat2 - lat1) / 2), 2)
                  + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))))""",
    ),
    "TO_KUDU_STRING": ("input STRING", "STRING", "input"),
}


def create_sql_function(spark: SparkSession, name: str, inputs: str, output: str, body: str,
                        description: str = "") -> None:
    """Register a scalar function whose body is a SQL expression."""
    note = description.replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({inputs}) RETURNS {output} "
        f"COMMENT '{note}' RETURN {body}"
    )


def create_python_function(spark: SparkSession, name: str, function, output: str | None = None) -> None:
    """Register a Python function; give a ``pandas_udf`` to work on Arrow batches."""
    if output is None:
        spark.udf.register(name, function)
    else:
        spark.udf.register(name, function, output)


def register_builtin(spark: SparkSession) -> None:
    for name, (inputs, output, body) in SQL_FUNCTIONS.items():
        create_sql_function(spark, name, inputs, output, body)


def find_functions(spark: SparkSession, name: str) -> list[str]:
    """Names of registered functions equal to ``name``, ignoring case."""
    rows = spark.sql(f"SHOW USER FUNCTIONS LIKE '*{name.lower()}*'").collect()
    return [r[0] for r in rows if r[0].split(".")[-1].lower() == name.lower()]


def drop_function(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
