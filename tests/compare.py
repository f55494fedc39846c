"""Runs a named query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def difference(spark, con, sf: str, run, sql: str) -> str | None:
    df = run(spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows(names, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            at = next(i for i in range(len(g)) if g[i] != w[i])
            return f"column {sorted(names)[at]}: {str(g[at])[:300]!r} ({type(g[at]).__name__}) != {str(w[at])[:300]!r} ({type(w[at]).__name__}) in {str(g)[:200]}"
    return None
