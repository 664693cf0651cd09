"""Side-by-side comparison of registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def _kind(name: str) -> str:
    name = name.lower().split("(")[0]
    return {
        "tinyint": "int", "smallint": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
        "varchar": "string", "double": "double", "timestamp": "timestamp_ntz", "date": "date",
        "boolean": "boolean",
    }.get(name, name)


def differences(df, con, sql: str) -> str | None:
    """None if schema and rows agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: _kind(str(d[1])) for d in cursor.description}
    theirs = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    spark_types = dict(df.dtypes)
    unequal = {c: (spark_types[c], types[c]) for c in names if spark_types[c] != types[c]}
    if unequal:
        return f"types {unequal}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference {a} against {b}"
    if not ours:
        return "no rows"
    return None
