"""Queries beside their SQL, and what is registered."""

import pytest
from compare import check, connect

import __spark_entry__ as entry
from helpers import SF
from rillmark.llm import queries


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_and_sql_agree(spark, con, name):
    assert check(spark, con, SF, name, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
