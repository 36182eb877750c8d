import pytest

from aerolake.plans.register import queries
from conftest import SF_SMALL
from plan_utils import plan_text

LAZY = [
    "bronze_states_decode", "silver_typed_projection", "silver_validity_filter", "silver_rejects",
    "silver_dedup_positions", "silver_flight_positions", "gold_flight_positions",
    "gold_country_metrics", "ground_state_counts", "serving_fold_positions", "serving_fold_metrics",
    "latest_positions_topk", "busiest_countries_topk", "serving_row_counts", "contract_violations",
    "upsert_result", "upsert_counts", "insert_ignore_result",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_plan(spark, name):
    text = plan_text(queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in text
    # no all-pairs joins anywhere
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_dedup_uses_window_group_limit(spark):
    text = plan_text(queries()["silver_flight_positions"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text


def test_topk_is_take_ordered(spark):
    text = plan_text(queries()["latest_positions_topk"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_aggregates_and_folds_reduce_before_the_shuffle(spark):
    text = plan_text(queries()["serving_fold_metrics"](spark, SF_SMALL))
    assert "partial_count" in text
    assert text.count("WindowGroupLimit") >= 4  # dedup and fold, each Partial + Final


def test_events_scan_is_pruned(spark):
    text = plan_text(queries()["gold_country_metrics"](spark, SF_SMALL))
    read_schema = [l for l in text.splitlines() if "ReadSchema" in l][0]
    assert "props" not in read_schema
