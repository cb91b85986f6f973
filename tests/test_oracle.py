"""Every registered query against its SQL twin (DuckDB) on the smallest
tables; queries without a twin must at least run and return rows."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SMALL
from tests.oracle import compare, duck_connection

QUERIES = entry_mod.queries()
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL)


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), SQL[name], con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_twin(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["id", "label", "prediction", "probability"]
    assert df.count() > 0
