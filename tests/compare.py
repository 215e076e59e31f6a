"""Order-insensitive comparison of a Spark result with the same SQL in DuckDB."""

import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, sql: str, connection) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    right = rows_of(columns, result.fetchall())
    if left != right:
        return (f"{sum(left.values())} / {sum(right.values())} rows; "
                f"only Spark {list((left - right).items())[:2]}; only SQL {list((right - left).items())[:2]}")
    return None
