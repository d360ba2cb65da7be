"""Shapes of physical plans that must hold at any scale."""

import re

import pytest

import __spark_entry__ as driver
from callsift.operators import replay as rp
from callsift.plans import inputs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "turns_base", "read_chunks", "turn_context", "analyze_turns", "redact_names",
    "screen_rubric", "budget_exhausted", "grade_episodes", "grade_match",
    "score_completions", "parse_completions", "tier_dashboard", "review_queue",
    "document_confusion", "redact_structured", "pii_census",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products_and_no_python(spark, small, name):
    plan = _plan(driver.queries()[name](spark, small))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert banned not in plan


def test_context_spreads_long_calls(spark, small):
    plan = _plan(driver.queries()["analyze_turns"](spark, small))
    assert re.search(r"Exchange hashpartitioning\(call_id#\w+, _part#\w+", plan)


def test_replay_moves_the_actions_once(spark, small):
    steps = rp.replay(inputs.actions(spark, small), order=inputs.ORDER)
    plan = _plan(rp.budget_exhausted(steps))
    # One for the distinct episodes, one for the actions; one sort for all windows.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_grades_read_the_replay_once(spark, small):
    plan = _plan(driver.queries()["grade_episodes"](spark, small))
    assert len(re.findall(r"Window \[", plan)) == 3


def test_scans_read_only_the_columns_used(spark, small):
    plan = _plan(driver.queries()["turn_position"](spark, small))
    schema = re.findall(r"ReadSchema: (\S+)", plan)
    assert schema == ["struct<conv_id:bigint,turn:bigint>"]
