"""Plan-shape regression tests: the scale properties the design relies on."""

import pytest

import __spark_entry__ as E

from .conftest import SMALL_SF

PURE = ["gold_features", "latest_per_key", "quality_gate_report", "confusion_metrics", "auc_rank",
        "scaled_features", "requests_per_second", "class_distribution", "latency_quantiles",
        "error_alert", "alert_groups", "contract_errors", "rule_grid_runs", "log_parse"]


def plan(spark, name):
    return E.queries()[name](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_cartesian_or_row_python(spark, name):
    p = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_latest_per_key_combines_before_shuffle(spark):
    p = plan(spark, "latest_per_key")
    assert p.index("Exchange hashpartitioning") < p.index("partial_max_by")   # partial below the shuffle


def test_order_profile_combines_before_shuffle(spark):
    p = plan(spark, "gold_features")
    assert "partial_count" in p and "partial_sum" in p


@pytest.mark.parametrize("name", ["requests_per_second", "latency_quantiles", "error_alert"])
def test_sliding_windows_do_not_expand_raw_rows(spark, name):
    p = plan(spark, name)
    assert "Expand" not in p and "Generate explode" in p      # fan-out happens on minute rows


def test_scans_prune_columns(spark):
    p = plan(spark, "requests_per_second")
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


@pytest.mark.parametrize("name", ["auc_rank", "rule_grid_runs"])
def test_auc_per_score_pass_is_shared(spark, name):
    qe = E.queries()[name](spark, SMALL_SF)._jdf.queryExecution()
    qe.toRdd().count()                                    # settle the adaptive plan
    assert "ReusedExchange" in qe.executedPlan().toString()
