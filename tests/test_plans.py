"""What the plans may and may not contain."""

import pytest

from reelforge.plans.catalog import QUERIES

PYTHON_STEPS = {"unknown_char_map", "knn_impute", "knn_embeddings", "wide_correlations"}
FITTED = {"rf_predictions", "rf_alignment", "logreg_predictions", "logreg_evaluation", "cv_grid", "auc_eval", "rf_quality", "logreg_optimum", "accuracy_ladder"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in FITTED])
def test_no_cross_join_and_no_row_wise_python(spark, small_dir, name):
    plan = plan_of(QUERIES[name].build(spark, small_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_STEPS:
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    plan = plan_of(QUERIES["incremental_anti"].build(spark, small_dir))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_top_k_is_not_a_full_sort(spark, small_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["topk_desc"].build(spark, small_dir))


def test_only_bounded_windows_are_unpartitioned(spark, small_dir):
    """A window without partitions runs in one task; only the table of bucket sizes may have one."""
    for name in QUERIES:
        if name in FITTED:
            continue
        plan = plan_of(QUERIES[name].build(spark, small_dir))
        # "Window [functions], [partition], [order]", where empty brackets are left out
        windows = [line.split("], [") for line in plan.splitlines() if "Window [" in line]
        unpartitioned = ["], [".join(w) for w in windows if len(w) == 1 or len(w) == 2 and (" ASC " in w[1] or " DESC " in w[1])]
        assert all("windowspecdefinition(_bucket" in line and "-1))" in line for line in unpartitioned), (name, unpartitioned)
