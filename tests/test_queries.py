"""Every registered query against its SQL."""

import os

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as driver
from tallyward.workload.oracle import ORACLE
from tallyward.workload.queries import QUERIES

FOLDER = "/root/testdata/" + os.environ.get("TALLYWARD_TEST_SF", "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert rows
    assert [r.month for r in rows] == sorted(r.month for r in rows)
