"""Compares Spark results with DuckDB's for the same files."""

from __future__ import annotations

import os

import duckdb

from geoloom.plans.views import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        p = f"{sf_dir}/{t}.parquet"
        p = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def same(df, con, sql: str) -> None:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == want
