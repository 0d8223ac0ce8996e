"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_queries import difference, oracle_connection

import __spark_entry__ as registry
from tallyloom.plans.oracles import ORACLES
from tallyloom.plans.workload import QUERIES_BY_NAME


@pytest.fixture(scope="module")
def connection(small):
    return oracle_connection(small)


def test_every_query_has_its_sql():
    assert QUERIES_BY_NAME.keys() == ORACLES.keys()
    assert registry.queries().keys() >= QUERIES_BY_NAME.keys()


@pytest.mark.parametrize("name", QUERIES_BY_NAME)
def test_query(spark, connection, small, name):
    assert difference(spark, connection, small, name) == ""


def test_entry_has_rows(spark):
    assert registry.entry(spark).columns == ["x", "y", "pmi", "rank"]
    assert registry.entry(spark).count() > 0
