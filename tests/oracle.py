"""Runs a query and its SQL on the same tables and compares all values."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    frame = con.sql(sql)
    names = list(frame.columns)
    return names, frame.fetchall()


def normal(value):
    """Python value with NaN as None and time zones dropped."""
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return float(f"{value:.10g}") + 0.0
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def kinds(rows):
    if not rows:
        return []
    return [sorted({type(r[i]).__name__ for r in rows if r[i] is not None}) for i in range(len(rows[0]))]


def compare(names, rows, other_names, other_rows) -> list[str]:
    if sorted(names) != sorted(other_names):
        return [f"columns {sorted(names)} != {sorted(other_names)}"]
    order = sorted(names)
    mine = [tuple(normal(r[names.index(c)]) for c in order) for r in rows]
    theirs = [tuple(normal(r[other_names.index(c)]) for c in order) for r in other_rows]
    problems = []
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows != {len(theirs)} rows")
    for column, a, b in zip(order, kinds(mine), kinds(theirs)):
        if a and b and a != b:
            problems.append(f"{column}: {a} != {b}")
    a, b = Counter(mine), Counter(theirs)
    for only, label in ((a - b, "query"), (b - a, "oracle")):
        if only:
            problems.append(f"{sum(only.values())} rows only in {label}, e.g. {dict(zip(order, next(iter(only))))}")
    return problems


def check(spark, name: str, sf_dir: str) -> tuple[list[str], int]:
    from touchline.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return ([] if rows else ["no rows"]), len(rows)
    names, expected = oracle_rows(ORACLES[name], sf_dir)
    return compare(df.columns, rows, names, expected), len(rows)
