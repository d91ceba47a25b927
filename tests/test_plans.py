"""The physical plans keep what the design relies on."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from millwright.operators import sampling
from millwright.plans import explore_queries

QUERIES = entry.queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith("q_")))
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", ["q_sensor_flatten_arm_robot", "q_cdc_classify", "q_ratio_features_cnc_machine"])
def test_a_message_is_parsed_once(spark, sf_dir, name):
    assert plan(spark, sf_dir, name).count("from_json(") == 1


def test_a_record_is_parsed_once_before_its_arrays_are_exploded(spark, sf_dir):
    text = plan(spark, sf_dir, "q_star_parts")
    # One typed parse; the parse as text runs only for records that did not fit.
    assert text.count("explode(array(from_json(") == 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "q_daily_slice")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    latest = plan(spark, sf_dir, "q_upsert_latest")
    assert "l_extendedprice" not in latest


def test_look_back_shuffles_by_machine_and_slice(spark, sf_dir):
    text = plan(spark, sf_dir, "q_train_features_arm_robot")
    lags = [line for line in text.splitlines() if "Window [lag" in line]
    assert lags and all("_slice" in line for line in lags)


def test_plain_split_needs_no_shuffle(spark, sf_dir):
    rows = explore_queries.history(spark, sf_dir).select("event_id", "failure")
    train, _ = sampling.train_test(sampling.with_fold(rows, ["event_id"]), ["event_id"])
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_exact_split_moves_and_sorts_no_rows(spark, sf_dir):
    """The cuts, a row per class, come to the rows."""
    text = plan(spark, sf_dir, "q_split")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Window" not in text
