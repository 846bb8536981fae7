"""Every registered query of the library proper against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, duckdb_types, run_duckdb, run_spark, spark_types
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().items() >= QUERIES.items()
    assert contract.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES[name]
    got_columns, got = run_spark(df)
    want_columns, want = run_duckdb(con, sql)
    assert got_columns == want_columns
    assert len(got) == len(want)
    assert got == want
    assert got, "a query over the whole tables should find rows"
    assert spark_types(df) == duckdb_types(con, sql)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
