"""Every registered query of the library against its SQL; tests/llm has the corpus operators'."""

import pytest
from oracle_check import connect, difference

import __spark_entry__ as driver
from footfall.plans.catalog import QUERIES
from footfall.plans.logs import LOG_QUERIES
from footfall.plans.streams import STREAM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", {**QUERIES, **LOG_QUERIES, **STREAM_QUERIES})
def test_query_matches_sql(spark, tables, name):
    assert difference(driver.queries()[name](spark, SF), tables, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    own = {**QUERIES, **LOG_QUERIES, **STREAM_QUERIES}.keys()
    assert own <= driver.queries().keys() and own <= driver.oracle_sql().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
