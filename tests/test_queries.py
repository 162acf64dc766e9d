"""Every registered query at sf0.001 against its oracle; queries without one must return rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "error_rate_5min" in df.columns


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
