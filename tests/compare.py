"""Row-for-row comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(v)) for v in row])


def spark_rows(frame):
    return sorted(frame.columns), _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(con, text):
    result = con.execute(text)
    names = [d[0] for d in result.description]
    return sorted(names), _sorted_rows(names, result.fetchall())
