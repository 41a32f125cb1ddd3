"""Rows of a Spark frame against rows of DuckDB SQL, in any order."""

import datetime
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    try:
        return repr(round(float(x), 9) + 0.0)
    except (TypeError, ValueError):
        return str(x)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


def same(frame, con, sql):
    expected = con.sql(sql)
    assert sorted(frame.columns) == sorted(expected.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: kinds.get(t, t) for c, t in frame.dtypes} == types
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows(expected.columns, expected.fetchall())
