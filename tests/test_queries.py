"""Every registered query against its DuckDB oracle on the smallest test tables (the driver runs
the same comparison at sf0.01)."""
import pytest

from tidewater.harness.catalog import QUERIES
from tidewater.harness.check import duck_connection
from tidewater.harness.compare import diff

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    fn, sql = QUERIES[name]
    df = fn(spark, SF)
    rows = df.collect()
    assert sql is not None, "every registered query has an oracle"
    cur = duck.execute(sql)
    problem = diff(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
    assert problem is None, problem


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and [c for c, _ in df.dtypes][0] == "month"
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
