"""Physical plans: no cross joins, no Python on the hot path, pruned and pushed-down scans."""

import pytest

import __spark_entry__ as driver

QUERIES = driver.queries()
LONG = {"cv_search", "experiment_end_to_end"}
PYTHON = {"promotion_history"}  # the replay streams in Arrow batches


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_no_cross_join_and_no_row_python(built, name):
    plan = _plan(built(name))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert name in PYTHON or "MapInPandas" not in plan


def test_scans_are_pruned_and_filters_pushed(spark, sf_dir):
    plan = _plan(QUERIES["class_counts"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan
    plan = _plan(QUERIES["production_model"](spark, sf_dir))
    assert "Not(EqualTo(event_type,error))" in plan and "props" not in plan
