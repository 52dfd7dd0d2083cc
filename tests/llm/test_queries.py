"""Registered operator queries against their SQL on the driver's tables."""

import pytest

from tidewater.harness.check import duck_connection
from tidewater.harness.compare import diff
from tidewater.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    assert diff(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) is None
