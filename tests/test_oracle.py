"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from kubus import oracle_queries, queries
from oracle_harness import compare, duck

NAMES = sorted(queries.registry())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(oracle_queries.registry()) == set(queries.registry())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, sf_small, name):
    r = compare(spark, con, name, sf_small, E.queries()[name], E.oracle_sql().get(name))
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "aggregation_level" in df.columns
