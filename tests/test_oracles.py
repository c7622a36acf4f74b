"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as entry
from tickerlake.plans.catalog import QUERIES
from tickerlake.plans.oracles import ORACLES

from compare import compare, duck
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    r = compare(name, got, want)
    assert r.ok, f"{name}: rows {r.rows_spark} vs {r.rows_oracle}; {r.detail}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["symbol", "date", "close_price"]
    assert df.count() > 0
