"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from locusflow.catalog.queries import QUERIES as OWN

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    problem = difference(spark, con, QUERIES[name], ORACLE[name], SF_DIR)
    assert problem is None, problem


def test_every_own_query_has_sql():
    assert OWN.keys() <= ORACLE.keys()


def test_entry(spark):
    assert entry(spark).count() > 0
