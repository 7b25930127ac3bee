"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from tools.check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
@pytest.mark.parametrize("name", list(driver.queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    ok, note, _ = compare(spark, con, SF_DIR, name, SQL.get(name))
    assert ok, note


def test_every_sql_has_a_query():
    assert set(SQL) <= set(driver.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
def test_entry_has_rows(spark):
    assert not driver.entry(spark).isEmpty()
