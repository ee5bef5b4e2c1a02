"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from sideline.plans.catalog import QUERIES as CATALOG  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

from conftest import SF001  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF001)


def test_every_query_has_an_oracle():
    """The library's own queries; others may have none."""
    assert set(CATALOG) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF001, verbose=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "win_pct" in df.columns
