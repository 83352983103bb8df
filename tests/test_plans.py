"""Physical-plan checks: pushdown reaches the scan, no cartesian products,
no single-partition exchange over raw rows."""

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_filter_pushed_to_scan(spark):
    p = plan(queries()["scan_date_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_projection_pruned(spark):
    p = plan(queries()["annualized_vol"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string,l_linestatus:string" in p
    assert "l_orderkey" not in p and "l_tax" not in p


@pytest.mark.parametrize("key", ["corr_matrix", "backtest_grid", "density_curve", "pair_sum_join",
                                 "anti_join_previous", "stratified_split", "top_n_ties", "cross_param_grid",
                                 "soft_vote", "group_min_offset", "histogram_bins"])
def test_no_cartesian_product(spark, key):
    p = plan(queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_knn_compares_blocks(spark):
    p = plan(queries()["knn_join"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "MapInArrow" in p
