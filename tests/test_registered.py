"""Every registered query against its SQL twin on the smallest driver tables."""

from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, name, driver.queries()[name], driver.oracle_sql().get(name), SF)
    assert result["ok"] is not False, result


def test_sql_names_are_registered():
    assert set(driver.oracle_sql()) <= set(driver.queries())
