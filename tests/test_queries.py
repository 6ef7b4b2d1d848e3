"""Every registered query beside its SQL, on the smallest tables."""

import os

import pytest
from compare import check, connect

import registry

registry.load()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, SF_DIR, name, registry.QUERIES[name], registry.ORACLE.get(name)) is None


def test_every_query_has_sql():
    assert set(registry.ORACLE) == set(registry.QUERIES)
