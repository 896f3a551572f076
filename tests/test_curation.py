import pytest
from oracle import agree, connection

from reelsieve.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, small, name):
    agree(spark, con, registry.queries()[name], SQL[name], small)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_runs_without_sql(spark, small, name):
    rows = registry.queries()[name](spark, small)
    assert rows.columns and rows.count() > 0
