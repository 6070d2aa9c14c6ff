"""Every registered query against its SQL on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from registry.base import REGISTRY

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, db, name):
    assert compare(queries()[name](spark, FOLDER), db, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
