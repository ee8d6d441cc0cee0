"""Spark rows against DuckDB rows: as multisets, columns by name, doubles to nine digits."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (int, float, decimal.Decimal)):
        x = float(x)
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x).replace(" 00:00:00", "")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return bytes(x) if isinstance(x, bytearray) else x


def multiset(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs."""
    rel = con.sql(sql)
    a, b = multiset(df.columns, df.collect()), multiset(rel.columns, rel.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    if a[1] != b[1]:
        more, less = a[1] - b[1], b[1] - a[1]
        return f"rows {sum(a[1].values())} and {sum(b[1].values())}; only Spark {list(more)[:3]}; only SQL {list(less)[:3]}"
    return ""
