"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from givingledger.params import ExportParams
from givingledger.plans.export import donor_export
from givingledger.sources.tables import DonorTables, table_schema

START = datetime(2023, 7, 1)
AS_OF = datetime(2024, 1, 15)


def params(**changes) -> ExportParams:
    return ExportParams(**({"fiscal_start": START, "as_of": AS_OF} | changes))


def frame(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = table_schema(name)
    values = [tuple(row.get(column) for column in schema.names) for row in rows]
    return spark.createDataFrame(values, schema)


def make_tables(spark: SparkSession, **rows: list[dict]) -> DonorTables:
    return DonorTables(lambda name: frame(spark, name, rows.get(name, [])))


def donor(key: str = "d", **values) -> dict:
    return {"DonorProfileID": key} | values


def gift(amount, when=None, key: str = "d", **values) -> dict:
    """A donation; flags are off unless given."""
    return {
        "DonorProfileID": key,
        "Amount": None if amount is None else Decimal(str(amount)),
        "DonatedOn": when,
        "IsStock": False,
        "InKind": False,
    } | values


def export_rows(spark: SparkSession, run: ExportParams, ids=None, **rows) -> list[dict]:
    strict = rows.pop("strict", True)
    tables = make_tables(spark, **rows)
    return [row.asDict() for row in donor_export(tables, run, ids, strict=strict).collect()]


def export_row(spark: SparkSession, gifts: list[dict], run: ExportParams | None = None, **rows):
    """The export of the only donor."""
    rows.setdefault("donors", [donor()])
    (row,) = export_rows(spark, run or params(), donations=gifts, **rows)
    return row
