"""Plan shape of every registered query: no pairs of rows are ever formed (no nested-loop join,
no Cartesian product), and scans read only the columns they need."""
import pytest

from tidewater.harness.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# queries whose construction runs a job (materialised intermediates) are planned the same way
NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan, name
    assert "CartesianProduct" not in plan, name


def test_scan_prunes_columns(spark):
    plan = QUERIES["model_roi_monthly"][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the orders scan for sales reads 3 of its 6 columns
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
