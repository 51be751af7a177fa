"""Every registered query equals its DuckDB oracle (small scale factor)."""

import pytest

import __spark_entry__ as E
from claimflow.plans.catalog import QUERIES
from helpers import SF_SMALL
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r
