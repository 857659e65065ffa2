"""Compare registered queries with their SQL on DuckDB.

Run as a script: ``python tests/oracle.py [sf dir] [name part]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def tables(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(repr(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def kind(t: str) -> str:
    t = t.lower()
    names = {"integer": "int", "varchar": "string", "boolean": "bool", "timestamp_ntz": "timestamp"}
    return names.get(t, t)


def compare(spark, con, sf: str, fn, sql: str) -> tuple[int, list[str]]:
    df = fn(spark, sf)
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: kind(str(d[1])) for d in cursor.description}
    theirs = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return len(ours), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for n, t in df.dtypes:
        if kind(t) != types[n]:
            problems.append(f"type {n}: {t} vs {types[n]}")
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return len(ours), problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    con = tables(folder)
    sql, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if part not in name:
            continue
        began = time.time()
        try:
            if name in sql:
                n, problems = compare(session, con, folder, fn, sql[name])
            else:
                n, problems = len(fn(session, folder).collect()), []
        except Exception as error:
            n, problems = -1, [str(error)[:700]]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} rows={n} {time.time() - began:.1f}s "
              f"{'' if name in sql else '(no SQL)'} {problems or ''}", flush=True)
    print("bad:", bad)
