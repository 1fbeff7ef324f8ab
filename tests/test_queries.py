"""Every query with a SQL form gives the same rows as DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return compare.connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    difference, _ = compare.differences(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert difference is None
