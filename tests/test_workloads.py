"""Every registered query against its SQL on DuckDB, over whole tables."""

import datetime
import decimal
import os
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.workloads import WORKLOADS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in pathlib.Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(WORKLOADS) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(WORKLOADS))
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF)
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    places = [want.columns.index(c) for c in columns]
    expected = sorted(tuple(canonical(row[i]) for i in places) for row in want.fetchall())
    actual = sorted(tuple(canonical(row[c]) for c in columns) for row in got.collect())
    assert len(actual) == len(expected)
    assert actual == expected
