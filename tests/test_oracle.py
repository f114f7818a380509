"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tripmill.oracle_sql import ORACLE_SQL
from tripmill.queries import queries
from tests.oracle import connect, rows_of_spark, rows_of_sql

# Column types as Spark and DuckDB name them.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(data_dir):
    return connect(data_dir)


def test_every_query_has_sql():
    assert set(queries()) == set(ORACLE_SQL)
    assert set(queries()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_rows_as_sql(spark, duck, data_dir, name):
    sql = ORACLE_SQL[name]
    result = queries()[name](spark, data_dir)
    described = {row[0]: row[1] for row in duck.execute(f"describe {sql}").fetchall()}
    assert {column: TYPES[kind] for column, kind in result.dtypes} == described
    assert rows_of_spark(result) == rows_of_sql(duck, sql)


def test_entry_returns_rows(spark):
    assert registry.entry(spark).count() > 0
