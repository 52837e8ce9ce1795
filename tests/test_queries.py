"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from paperloom.workload.oracles import all_oracles
from paperloom.workload.queries import all_queries

QUERIES = {name: entry.queries()[name] for name in all_queries()}
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], sf_dir) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
