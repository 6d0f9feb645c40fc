"""Every query against its SQL in DuckDB."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from adapter import queries as own
from oracle import queries as oracle

QUERIES, ORACLE = own.all_queries(), oracle.all_queries()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_result(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None
