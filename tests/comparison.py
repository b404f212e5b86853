"""Comparing a Spark result with a DuckDB result: columns by name, rows in any order."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return ("nan",) if math.isnan(number) else ("number", number)
    if isinstance(value, int):
        return ("number", float(value)) if abs(value) < 2**53 else ("big", value)
    if isinstance(value, (datetime, date)):
        return ("time", value.isoformat())
    return ("text", str(value))


def ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in places], sorted([tuple(cell(r[i]) for i in places) for r in rows], key=repr)


def spark_rows(df):
    return ordered(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.cursor()
    cursor.execute(sql)
    names = [d[0] for d in cursor.description]
    return ordered(names, cursor.fetchall())


def difference(df, con, sql):
    """None if equal, else a short account."""
    names, rows = spark_rows(df)
    want_names, want = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    for got, expected in zip(rows, want):
        if got != expected:
            return "\n".join(f"{n}: {g} != {e}" for n, g, e in zip(names, got, expected) if g != e)
    return None
