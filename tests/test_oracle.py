"""Every query of the catalog against its DuckDB twin."""

from __future__ import annotations

import pytest
from compare import connect, duckdb_rows, spark_rows

from givingledger.plans.catalog import catalog
from oracle.duckdb_sql import oracle_queries

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_queries()


def test_every_query_has_sql():
    assert catalog().keys() == SQL.keys()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog()))
def test_same_rows(spark, duck, name):
    result = catalog()[name](spark, FOLDER)
    columns = [column[0] for column in duck.execute(SQL[name]).description]
    assert sorted(result.columns) == sorted(columns)
    assert spark_rows(result) == duckdb_rows(duck, SQL[name])
