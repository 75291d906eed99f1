"""The registered corpus queries that SQL can express, against their SQL on the smallest tables."""

import pytest

from checks.compare import compare, connect
from trendloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    same, note = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert same, note
