"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    """One form for equal values of either engine."""
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, int):
        return float(value) if abs(value) < 1 << 53 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if the rows are the same; else a short account of what differs."""
    names = df.columns
    mine = rows_of(names, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    other_names = [d[0] for d in found.description]
    other = rows_of(other_names, found.fetchall())
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} against {sorted(other_names)}"
    if mine == other:
        return None
    left, right = list((mine - other).items()), list((other - mine).items())
    key = lambda x: str(x)
    return (
        f"{sum(mine.values())} rows against {sum(other.values())}; only here {sum(n for _, n in left)}: "
        f"{sorted(left, key=key)[:3]}; only there {sum(n for _, n in right)}: {sorted(right, key=key)[:3]}"
    )
