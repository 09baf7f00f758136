"""Driver contract + every oracle query against DuckDB at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["date", "CountryCode"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
