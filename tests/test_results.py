"""Every query against the SQL that states its result, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillsight.catalog import QUERIES
from tools.check_results import compare, duckdb_on

SF = "/root/testdata/sf0.001"
#: The queries of the optional subpackage have tests of their own.
OWN = {n: q for n, q in queries().items() if n in QUERIES}
SQL = {n: q for n, q in oracle_sql().items() if n in OWN}


@pytest.fixture(scope="module")
def con():
    return duckdb_on(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, queries()[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(OWN) - set(SQL)))
def test_returns_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).columns[:2] == ["age_group", "category"]
