"""Side-by-side comparison of a registered query with its DuckDB text."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_norm(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns)) if columns else []


def _types(table) -> dict[str, str]:
    short = {"large_string": "string", "string_view": "string"}
    return {f.name: short.get(str(f.type), str(f.type)) for f in table.schema}


def differences(df, sql: str, con) -> list[str]:
    """Empty if names, types and all values agree."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    a, b = _types(ours), _types(theirs)
    if a != b:
        found.append(f"types: {[(n, a.get(n), b.get(n)) for n in sorted(set(a) | set(b)) if a.get(n) != b.get(n)]}")
    if sorted(a) != sorted(b):
        return found
    x, y = _rows(ours), _rows(theirs)
    if len(x) != len(y):
        found.append(f"rows: {len(x)} != {len(y)}")
    if x != y:
        names = sorted(a)
        for r, s in zip(x, y):
            if r != s:
                found.append(f"first difference: {[(n, p, q) for n, p, q in zip(names, r, s) if p != q]}")
                break
    return found
