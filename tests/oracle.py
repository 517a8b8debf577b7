"""Compare registered queries with their SQL on DuckDB: names, types, counts, values."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
KINDS = {"bigint": "int", "int": "int", "string": "str", "double": "float", "boolean": "bool"}
DUCK_KINDS = {"int64": "int", "int32": "int", "object": "str", "str": "str", "string": "str", "float64": "float", "bool": "bool"}


def connect(sf):
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return duck


def differences(frame, duck, sql):
    """What differs between a Spark frame and a SQL text; empty when equal."""
    relation = duck.sql(sql)
    names = sorted(frame.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    types = {c: t.lower() for c, t in zip(relation.columns, map(str, relation.types))}
    duck_types = {c: {"varchar": "string", "integer": "int"}.get(t, t) for c, t in types.items()}
    spark_types = dict(frame.dtypes)
    wrong = [f"{c}: {spark_types[c]} != {duck_types[c]}" for c in names if spark_types[c] != duck_types[c]]
    if wrong:
        return f"types {wrong}"
    quoted = ", ".join(f'"{c}"' for c in names)
    expected = sorted(map(repr, duck.sql(f"SELECT {quoted} FROM ({sql}) q").fetchall()))
    actual = sorted(repr(tuple(r)) for r in frame.select(*[f"`{c}`" for c in names]).collect())
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    odd = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(odd)} rows differ, first {odd[0]}" if odd else ""
