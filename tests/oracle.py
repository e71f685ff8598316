"""Compares a query with its SQL in DuckDB over the same tables: row count, column names, values in any order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted((repr([plain(r[k]) for k in order]) for r in rows))


def differences(con, sql: str, frame) -> str:
    """What differs, or ''."""
    want = con.sql(sql)
    names, expected = rows_of(want.columns, want.fetchall())
    have, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if names != have:
        return f"columns {have}, wanted {names}"
    if len(got) != len(expected):
        return f"{len(got)} rows, wanted {len(expected)}"
    bad = [(a, b) for a, b in zip(got, expected, strict=True) if a != b]
    return f"{len(bad)} rows differ, such as {bad[0][0][:300]} wanted {bad[0][1][:300]}" if bad else ""
