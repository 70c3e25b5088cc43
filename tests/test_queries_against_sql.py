"""Every registered query with an SQL statement gives the same rows in DuckDB."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as entry
from tools.check import connect, differences

SQLS = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(SQLS))
def test_same_rows(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQLS[name], SF) == []


def test_every_statement_belongs_to_a_query():
    from oracle.statements import SQL

    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["capacity_assumption"] == 500
