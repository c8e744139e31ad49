"""Run a registered query and its SQL on the same Parquet files and compare all values."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


SAME_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, types, row numbers and values agree."""
    expected = con.sql(sql)
    types = dict(zip(expected.columns, map(str, expected.types)))
    if sorted(df.columns) != sorted(types):
        return [f"columns {sorted(set(df.columns) ^ set(types))}"]
    found = [f"{n}: {t} / {types[n]}" for n, t in df.dtypes if SAME_TYPES.get(t) != types[n]]
    ours, theirs = _rows(df.columns, df.collect()), _rows(expected.columns, expected.fetchall())
    if ours != theirs:
        found.append(f"{sum(ours.values())} / {sum(theirs.values())} rows, columns {sorted(df.columns)}")
        found += [f"only Spark {r}" for r in list((ours - theirs))[:3]] + [f"only SQL {r}" for r in list((theirs - ours))[:3]]
    return found
