"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from compare import compare, connect

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, query in registered.queries().items() if name in registered.QUERIES}
SQL = registered.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(ROOT)


def test_names():
    assert list(QUERIES) and set(QUERIES) <= set(SQL)
    assert set(SQL) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, ROOT, QUERIES[name], SQL[name], db) is None


def test_entry(spark):
    assert registered.entry(spark).columns
