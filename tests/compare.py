"""Rows of a query against rows of its SQL, as multisets with columns by name."""

from __future__ import annotations

import datetime
import decimal
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = fn(spark, sf_dir)
    got_names, got = multiset(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    rows = sum(got.values())
    if sql is None:
        return None, rows, seconds
    cursor = con.execute(sql)
    want_names, want = multiset([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", rows, seconds
    if got != want:
        extra = list((got - want).items())[:3]
        lacking = list((want - got).items())[:3]
        return f"rows {rows} vs {sum(want.values())}; only here {str(extra)[:400]}; only expected {str(lacking)[:400]}", rows, seconds
    return None, rows, seconds
