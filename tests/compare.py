"""Run registered queries on Spark and their SQL on DuckDB and compare all values.

    python tests/compare.py [folder] [name part ...]
"""

from __future__ import annotations

import datetime as dt
import math
import pathlib
import sys
import time

import duckdb
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def ordered(columns: list[str], rows: list[tuple]) -> list[tuple]:
    positions = sorted(range(len(columns)), key=lambda at: columns[at])
    picked = [tuple(plain(row[at]) for at in positions) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


SPARK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, connection, folder: str, query, sql: str) -> str:
    """Empty text when both sides agree."""
    frame = query(spark, folder)
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    types = {column[0]: str(column[1]) for column in answer.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns differ: {sorted(set(names) ^ set(frame.columns))}"
    for name, kind in frame.dtypes:
        if SPARK_TYPES.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} against {types[name]}"
    expected = ordered(names, answer.fetchall())
    actual = ordered(frame.columns, [tuple(row) for row in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        cells = [
            (name, x, y)
            for name, x, y in zip(sorted(names), *wrong[0])
            if x != y
        ]
        return f"{len(wrong)} of {len(actual)} rows differ, first: {cells[:6]} in {wrong[0][0][:8]}"
    return ""


def main(folder: str = "/root/testdata/sf0.01", *parts: str) -> int:
    from __spark_entry__ import oracle_sql, queries

    # A session without the library's settings: queries bring their own.
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(folder), oracle_sql()
    failures = 0
    for name, query in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.time()
        try:
            if name in sql:
                found = difference(spark, connection, folder, query, sql[name])
                rows = ""
            else:
                found, rows = "", f"{query(spark, folder).count()} rows, no SQL"
        except Exception as failure:
            found = f"{type(failure).__name__}: {str(failure)[:600]}"
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name} {found or rows}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
