"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_KINDS = {
    "tinyint": "int32", "smallint": "int32", "integer": "int32", "int": "int32", "bigint": "int64",
    "varchar": "string", "string": "string", "double": "double", "float": "float", "boolean": "boolean",
    "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp", "hugeint": "hugeint",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _kind(name: str) -> str:
    return _KINDS.get(name.lower(), name.lower())


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as readable lines; empty if names, types and rows agree."""
    problems = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    for name, kind in df.dtypes:
        if _kind(kind) != _kind(str(types[name])):
            problems.append(f"type of {name}: {kind} instead of {types[name]}")
    order = sorted(names)
    where = [names.index(n) for n in order]
    want = Counter(tuple(_plain(row[i]) for i in where) for row in expected)
    got = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in order]).collect())
    if want != got:
        problems.append(f"{sum(got.values())} rows instead of {sum(want.values())}")
        problems += [f"  surplus {r}" for r in list((got - want))[:3]] + [f"  missing {r}" for r in list((want - got))[:3]]
    return problems
