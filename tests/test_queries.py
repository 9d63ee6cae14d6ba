"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from podwatch.checks.oracles import ORACLES
from podwatch.checks.queries import QUERIES, TEST_TABLES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TEST_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = contract.queries()[name](spark, SF)
    found = connection.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    expected = canonical(columns, found.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.schema == contract.entry(spark).schema
