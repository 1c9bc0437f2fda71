"""Every contract query against its SQL oracle on the smallest data set."""

import pytest

import __spark_entry__ as entry
from doclake.queries.registry import ORACLES, QUERIES
from tests.contract import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "status", "amount"]
