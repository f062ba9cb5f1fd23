"""Side-by-side run of one query on Spark and its checking SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return None if v is None else f"{type(v).__name__}:{v}"


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, v or "") for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    expected = _rows(sql_names, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} vs {sorted(sql_names)}"
    if got == expected:
        return None
    first = next((i for i, (a, b) in enumerate(zip(got, expected)) if a != b), min(len(got), len(expected)))
    return (
        f"rows {len(got)} vs {len(expected)}; columns {sorted(df.columns)}; at {first}:\n"
        f"  spark {got[first:first + 2]}\n  check {expected[first:first + 2]}"
    )
