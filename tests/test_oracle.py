"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from compare import compare_one, duck
from conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_own_query_has_an_oracle():
    assert set(E._QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, name, E.queries()[name], SQL[name], SF_SMALL, E.ORDERED.get(name))
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert r.get("order_match", True), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "aqi" in df.columns and "prominent_pollutant" in df.columns
