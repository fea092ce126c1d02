"""Comparison of a Spark result with a DuckDB result, without regard to row order."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def compare(actual: DataFrame, connection, sql: str) -> tuple[str, int]:
    """An empty text if both hold the same rows, else what differs; and the row count."""
    found = actual.toArrow()
    expected = connection.sql(sql).to_arrow_table()
    names = sorted(found.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} and {sorted(expected.column_names)}", found.num_rows
    types = [
        f"{n}: {found.schema.field(n).type} and {expected.schema.field(n).type}"
        for n in names
        if _kind(found.schema.field(n).type) != _kind(expected.schema.field(n).type)
    ]
    if types:
        return "types " + ", ".join(types), found.num_rows
    if found.num_rows != expected.num_rows:
        return f"{found.num_rows} and {expected.num_rows} rows", found.num_rows
    left, right = _rows(found, names), _rows(expected, names)
    for a, b in zip(left, right):
        if a != b:
            return f"first difference\n  {a}\n  {b}", found.num_rows
    return "", found.num_rows


def _kind(arrow_type) -> str:
    name = str(arrow_type)
    return "string" if "string" in name else name


def _rows(table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))
