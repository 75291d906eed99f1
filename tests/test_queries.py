"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    same, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert same, note


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    rows = entry(spark).collect()
    scores = [r["trend_score"] for r in rows]
    assert len(rows) == 20 and scores == sorted(scores, reverse=True)
    assert set(oracle_sql()) <= set(queries())
