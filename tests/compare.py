"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([[plain(row[i]) for i in order] for row in rows], key=repr)


def spark_rows(df):
    return as_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return as_rows(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    columns, got = spark_rows(df)
    want_columns, want = duck_rows(con, sql)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
