"""Every query with an SQL form gives the rows of that SQL."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert difference(entry.queries()[name](spark, sf_dir), duck, SQL[name]) is None


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_gives_the_payment_report(spark):
    assert entry.entry(spark).columns == ["payment_method", "transaction_count"]
