"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(v):
    if isinstance(v, dt.datetime) and v.tzinfo is None:
        return v.isoformat()
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return ("f", repr(v + 0.0))
    return v


def _kind(v):
    return None if v is None else type(v).__name__


def differences(spark, con, query, sql: str, sf_dir: str, show: int = 3) -> list[str]:
    return frame_differences(query(spark, sf_dir), con, sql, show)


def frame_differences(df, con, sql: str, show: int = 3) -> list[str]:
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    cursor = con.execute(sql)
    cols = [d[0] for d in cursor.description]
    if sorted(cols) != names:
        return [f"columns {names} != {sorted(cols)}"]
    at = [cols.index(n) for n in names]
    want = [tuple(r[i] for i in at) for r in cursor.fetchall()]
    problems = []
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not got:
        problems.append("no rows")
    for i, n in enumerate(names):
        kinds = [{_kind(r[i]) for r in rows} - {None} for rows in (got, want)]
        if kinds[0] != kinds[1] and all(kinds):
            problems.append(f"type of {n}: {kinds[0]} != {kinds[1]}")
    a = Counter(tuple(_plain(v) for v in r) for r in got)
    b = Counter(tuple(_plain(v) for v in r) for r in want)
    if a != b:
        problems.append(f"{sum((a - b).values())} rows differ")
        problems += [f"  spark {str(r)[:400]}" for r in sorted((a - b), key=str)[:show]]
        problems += [f"  sql   {str(r)[:400]}" for r in sorted((b - a), key=str)[:show]]
    return problems
