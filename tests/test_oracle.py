"""Every registered query against its SQL equivalent, over whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from lockweir.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    problem, rows = compare(spark, con, key, queries()[key], oracle_sql().get(key), SF)
    assert problem is None


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).limit(5).count() == 5
