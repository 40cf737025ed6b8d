"""Every registered query against its SQL, on the given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def comparable(value):
    # NULL sorts and compares apart from every value of any type.
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, f"{type(value).__name__}:{value!r}")


# DuckDB's name of each Spark type that results use.
SQL_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(comparable(row[i]) for i in order) for row in rows
    )


OWN = sorted(driver._own_queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, oracle, name):
    result = driver.queries()[name](spark, SF_DIR)
    expected = oracle.execute(driver.oracle_sql()[name])
    expected_columns = [column[0] for column in expected.description]
    types = dict((column[0], str(column[1])) for column in expected.description)
    assert {name: SQL_TYPES[kind] for name, kind in result.dtypes} == types
    got = table(result.columns, [tuple(row) for row in result.collect()])
    want = table(expected_columns, expected.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_every_query_has_sql():
    assert set(OWN) == set(driver._own_oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["speaker", "n_utterances", "n_tokens", "mlu_w"]
    assert result.count() == 3
