"""Every registered query against its DuckDB oracle on the smallest fixture (the
driver runs the same comparison at sf0.01); rows-only queries must run."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from harness import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"digest_date", "label", "title", "status"} <= set(df.columns)
    assert E.entry(spark).schema == df.schema                  # stable schema across calls
