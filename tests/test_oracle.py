"""Differential check: every registered query with an oracle against
DuckDB on sf0.001 (the driver runs the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from tools.check_oracle import compare, duck

ORACLE_NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_with_entry(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, SF_SMALL, name, con)
    assert ok, msg
