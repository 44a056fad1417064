"""Comparison of a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows(columns: list[str], values: list[tuple]) -> Counter:
    """Rows as a bag, columns in name order; values with their types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple((type(row[i]).__name__, row[i]) for i in order) for row in values
    )


def spark_rows(result: DataFrame) -> Counter:
    return rows(result.columns, [tuple(row) for row in result.collect()])


def duckdb_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> Counter:
    cursor = connection.execute(sql)
    return rows([d[0] for d in cursor.description], cursor.fetchall())
