"""The corpus queries that have SQL, against it."""

import compare
import pytest
from conftest import SMALL

from wardloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_result(spark, name):
    assert compare.difference(QUERIES[name](spark, SMALL), compare.connect(SMALL), ORACLE_SQL[name]) is None


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
