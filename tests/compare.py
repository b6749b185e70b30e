"""Runs a query and its SQL on the same tables and compares rows."""

import glob
import math
import os

import duckdb


def connect(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        inner = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{inner}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def differences(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    return [(a, b) for a, b in zip(got, want) if a != b] + [("rows", len(got), len(want))] * (len(got) != len(want))
