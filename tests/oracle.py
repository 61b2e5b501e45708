"""Runs a query's SQL on the same tables and compares all values."""

import math
import os

import duckdb


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "-"
    if isinstance(x, float):
        return f"{x:.6g}"
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    return str(x)


def connect(folder):
    con = duckdb.connect()
    con.sql("set TimeZone='UTC'")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            con.sql(f"create view {name[:-8]} as from read_parquet('{folder}/{name}')")
    return con


def compare(frame, con, sql):
    columns = sorted(frame.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    result = con.sql(sql)
    names = result.columns
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(dict(zip(names, r))[c]) for c in columns) for r in result.fetchall())
    assert mine == theirs
