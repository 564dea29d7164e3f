"""Run queries in Spark and their SQL in DuckDB on the same tables, and compare the rows."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(made, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def duck_rows(sql: str, d: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{d}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def difference(df, sql: str, d: str) -> str | None:
    """None if equal, else what differs."""
    (have_cols, have), (want_cols, want) = spark_rows(df), duck_rows(sql, d)
    if have_cols != want_cols:
        return f"columns {sorted(set(have_cols) ^ set(want_cols))}"
    if len(have) != len(want):
        return f"{len(have)} rows, want {len(want)}"
    for a, b in zip(have, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            cols = [(c, x, y) for c, x, y in zip(have_cols, a, b) if x != y or type(x) is not type(y)]
            return f"{cols[:4]} in {a[:3]}"
    return None
