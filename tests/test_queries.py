"""Every registered query runs, and agrees with its SQL on another engine."""

import pytest
from compare import compare, tables_in

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return tables_in(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 5
