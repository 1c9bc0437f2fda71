"""Every query of the package on the smallest tables: against its SQL, or at least whole."""

import pytest

from doclake.llm.queries import ORACLES, QUERIES
from tests.contract import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, QUERIES[name], ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
