"""Every registered query with SQL against DuckDB (the driver's gate, at sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck
from tests.conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, E.queries()[key], E.oracle_sql()[key], con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "mmsi"
