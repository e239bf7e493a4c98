"""Rows of a query against rows of its SQL, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return f"{float(v):.9g}"
    return str(v)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(cell(r[k]) for k in order) for r in rows)


def same(df, con, sql: str) -> None:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    a, b = bag(df.columns, df.collect()), bag(names, found.fetchall())
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
