"""Every query with a DuckDB twin must match it (row count, columns, values) at sf0.001."""

import pytest

from tests.oracle_check import compare, duck
from tests.conftest import SF_SMALL

import __spark_entry__ as entry_mod

SQL = entry_mod.oracle_sql()
QS = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, QS[name], SQL[name])
    assert r["status"] == "ok", r


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QS)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert "close" in df.columns and len(df.columns) == 39
    assert df.count() > 0
