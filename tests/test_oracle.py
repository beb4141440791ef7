"""Differential test: every registered query against its DuckDB text (small scale)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from costpulse.plans import registry
from costpulse.plans.compare import compare, duckdb_connection
from tests.conftest import SF_SMALL

SQL = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(SQL)
    assert set(SQL) <= set(entry.oracle_sql()) and set(SQL) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(registry.queries()[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "p95_latency_ms" in df.columns
