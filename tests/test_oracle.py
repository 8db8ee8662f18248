"""Every registered query against its SQL on the smallest tables; the others must return rows."""

import pytest
from conftest import SMALL
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, queries()[name], ORACLE[name], SMALL) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_every_statement_has_its_query():
    assert set(ORACLE) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 5
