"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from geomosaic import plans

SF_DIR = "/root/testdata/sf0.001"
#: A hull has no built-in expression.
HULLS = ("agg_footprint_corners",)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_plan_compares_no_side_with_all_of_another(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", *(["ArrowEvalPython"] if name not in HULLS else [])):
        assert operator not in plan


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["gx", "gy", "v", "n_candidates"]
