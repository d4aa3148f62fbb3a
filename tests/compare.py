"""Run queries and their oracle SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, statement: str) -> str | None:
    """None if both sides agree in columns, rows and values, else what differs."""
    found = con.execute(statement)
    want_names, want = _table([c[0] for c in found.description], found.fetchall())
    names, got = _table(df.columns, [tuple(row) for row in df.collect()])
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


def rows(df, *order):
    """Rows as tuples, ordered by the given columns, or by their text."""
    if order:
        return [tuple(r) for r in df.orderBy(*order).collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)
