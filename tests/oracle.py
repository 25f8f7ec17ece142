"""Run a registered query and its SQL on the same tables and compare them strictly."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_result(df):
    table = df.toArrow()
    names = table.column_names
    types = {n: str(t) for n, t in zip(names, table.schema.types)}
    return names, types, list(zip(*[c.to_pylist() for c in table.columns])) if names else []


def sql_result(connection, sql: str):
    table = connection.sql(sql).to_arrow_table()
    names = table.column_names
    types = {n: str(t) for n, t in zip(names, table.schema.types)}
    return names, types, list(zip(*[c.to_pylist() for c in table.columns])) if names else []


def difference(df, connection, sql: str) -> str | None:
    """What differs in names, types or values; None when all agree."""
    names, types, rows = spark_result(df)
    sql_names, sql_types, sql_rows = sql_result(connection, sql)
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} != {sorted(sql_names)}"
    different = {n: (types[n], sql_types[n]) for n in names if _kind(types[n]) != _kind(sql_types[n])}
    if different:
        return f"types {different}"
    left, right = _rows(names, rows), _rows(sql_names, sql_rows)
    if left != right:
        only, other = list((left - right).items())[:3], list((right - left).items())[:3]
        return f"{len(rows)} rows, {len(sql_rows)} expected; only Spark {only}; only SQL {other}"
    return None


def _kind(arrow_type: str) -> str:
    return {"large_string": "string"}.get(arrow_type, arrow_type.replace("decimal128", "decimal"))
