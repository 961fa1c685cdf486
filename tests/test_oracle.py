"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks import compare, oracle
from tests.conftest import SF
from tradelane import registry

SQL, QUERIES = oracle.oracle_sql(), registry.queries()
# at this scale some results are rightly empty (ten ports, few days)
MAY_BE_EMPTY = {"equal but empty"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem = compare.compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert problem is None or problem in MAY_BE_EMPTY


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "composite_risk_score" in df.columns
