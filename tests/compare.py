"""Holds a query's rows against those of its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def expected(sql: str, sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), bag(found.fetchall(), names)


def actual(df):
    return sorted(df.columns), bag([tuple(r) for r in df.collect()], df.columns)
