"""Exact, order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

_KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "double": "float", "float": "float",
    "string": "str", "boolean": "bool", "date": "date", "timestamp": "ts", "timestamp_ntz": "ts",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "float", "VARCHAR": "str",
    "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "ts",
}


def kind(type_name: str) -> str:
    return _KINDS.get(str(type_name), str(type_name).lower().replace(" ", ""))


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def spark_side(df):
    names = sorted(df.columns)
    kinds = [kind(df.schema[name].dataType.simpleString()) for name in names]
    return names, kinds, _sorted([tuple(plain(v) for v in row) for row in df.select(*names).collect()])


def duck_side(sf_dir: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = [tuple(plain(row[i]) for i in order) for row in cursor.fetchall()]
    return [described[i][0] for i in order], [kind(described[i][1]) for i in order], _sorted(rows)


def differences(df, sf_dir: str, sql: str, show: int = 3) -> list[str]:
    s_names, s_kinds, s_rows = spark_side(df)
    d_names, d_kinds, d_rows = duck_side(sf_dir, sql)
    found = []
    if s_names != d_names:
        return [f"columns: spark {s_names} duckdb {d_names}"]
    if s_kinds != d_kinds:
        found.append(f"types: {[(n, s, d) for n, s, d in zip(s_names, s_kinds, d_kinds) if s != d]}")
    if len(s_rows) != len(d_rows):
        found.append(f"rows: spark {len(s_rows)} duckdb {len(d_rows)}")
    different = [(s, d) for s, d in zip(s_rows, d_rows) if s != d]
    for s, d in different[:show]:
        found.append(f"row: {[(n, a, b) for n, a, b in zip(s_names, s, d) if a != b]}")
    if different:
        found.append(f"{len(different)} rows differ")
    return found
