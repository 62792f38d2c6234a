"""Every registered query equals its SQL on the test tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from orderflow.plans.oracle import ORACLE_SQL
from orderflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows = QUERIES[name](spark, SF_DIR)
    assert compare.assert_same(rows, con, ORACLE_SQL[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
