"""The driver contract: ``entry`` runs, and every registered query with an oracle matches DuckDB at sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from ledgerlens.plans.compare import compare, duckdb_connection  # noqa: E402

SMOKE = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "tx_time_seconds" in df.columns and "source_file" in df.columns


def test_every_query_has_a_section_and_a_callable():
    from ledgerlens.plans.registry import REGISTRY
    assert len(REGISTRY) >= 70
    assert all(e.section.startswith("2.") for e in REGISTRY.values())
    assert set(SQL) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMOKE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SMOKE), con, SQL[name])
    assert ok, msg
