"""Every registered query gives what its SQL gives on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from lakeops.workload import ORACLE, QUERIES as NAMES

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in entry.queries().items() if name in NAMES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = difference(QUERIES[name](spark, FOLDER), con, ORACLE[name])
    assert problem is None, problem


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1
