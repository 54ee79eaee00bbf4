"""Every registered query against its SQL on the smallest tables."""

import sys

import pytest

sys.path.insert(0, "tests")

import __spark_entry__ as entry
from oracle import compare, connect
from stationflow import queries as registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    same, _, difference = compare(registry.QUERIES[name](spark, FOLDER), con, registry.SQL[name])
    assert same, difference


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.SQL) <= set(entry.oracle_sql())
