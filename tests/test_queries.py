"""Every query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from brickrow.proof.oracles import ORACLES
from brickrow.proof.queries import QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con.sql(ORACLES[name])) == []


def test_entry(spark):
    assert entry(spark).count() > 0
