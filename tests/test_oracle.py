"""Every registered query against its SQL in DuckDB, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from .conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


def plain(rows):
    return sorted((tuple(str(value) for value in row) for row in rows))


@pytest.mark.parametrize("name", spark_entry.core_queries())
def test_query_equals_sql(spark, database, name):
    found = spark_entry.queries()[name](spark, SF)
    expected = database.execute(spark_entry.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(found.columns) == sorted(columns)
    rows = expected.fetchall()
    assert rows and plain(found.select(*columns).collect()) == plain(rows)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 397
