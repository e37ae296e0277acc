"""Every registered query against its DuckDB oracle, plus contract checks."""

import pytest

import __spark_entry__ as entry
from terrawatt.plans.registry import CATALOGUE
from tests.harness import SF_DIR, compare, duck

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(CATALOGUE) - set(ORACLES)))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert "total_energy_daily" in df.columns and df.count() > 0
