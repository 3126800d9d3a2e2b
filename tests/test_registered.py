"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from recontact.checks import registry
from tests.compare import difference, duckdb_over

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def small_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con(small_dir):
    return duckdb_over(small_dir)


def test_every_selection_has_a_twin():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, con, small_dir, name):
    problem, n = difference(QUERIES[name](spark, small_dir), con, ORACLE[name])
    assert problem is None, problem
    assert n > 0, "a query without rows checks nothing"


def test_entry_has_the_ledger_columns(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 16
    assert df.columns[:3] == ["select_id", "batch_id", "case_id"]
    assert df.count() > 0
