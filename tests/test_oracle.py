"""Every registered query against its SQL on another engine, cell by cell."""

import pytest
from shared import SF_DIR
from oracle import connect, differences

import __spark_entry__ as entry_points
from gatelog.catalog.all import EXPECTED, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_same_result(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1
    assert set(QUERIES) <= entry_points.queries().keys()
    assert set(EXPECTED) <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()
