"""Run a registered query and its oracle and compare them row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb

from terrawatt.plans.datasets import BASE_TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def text(value) -> str:
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return repr(float(value) + 0.0)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def table(rows, columns) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    got = table([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = table(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle has {len(want)}"
    extra, missing = list((Counter(got) - Counter(want)).elements()), list((Counter(want) - Counter(got)).elements())
    if extra:
        # Pair the unmatched rows that share most values, to show what differs.
        near = max(missing, key=lambda w: sum(a == b for a, b in zip(extra[0], w)))
        bad = [(n, a, b) for n, a, b in zip(sorted(names), extra[0], near) if a != b]
        return f"{len(extra)} rows differ, first: {bad}"
    return None
