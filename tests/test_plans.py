"""Properties of physical plans that keep the engine fit for large data."""

import re

import pytest

from panelmint.checks import QUERIES

FOLDER = "/root/testdata/sf0.001"


def executed(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_returns_read_and_shuffle_the_panel_once(spark):
    plan = executed(spark, "log_returns")
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_features_read_the_panel_once(spark):
    assert executed(spark, "rolling_features").count("FileScan") == 1


def test_lookback_filter_reaches_the_scan(spark):
    plan = executed(spark, "windowed_returns")
    # Long filter lists are cut in plan texts, so only the start of the list is looked at.
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


@pytest.mark.parametrize("name", ["walk_forward", "smart_basket"])
def test_raw_tables_are_read_once(spark, name):
    """Bars are written once; the plan behind the result starts from them."""
    assert executed(spark, name).count("FileScan") == 0


def test_ranking_is_cut_before_the_shuffle(spark):
    plan = executed(spark, "candidate_cap")
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 1


@pytest.mark.parametrize("name", ["walk_forward", "windowed_tournament", "rolling_features", "chrono_split", "row_cap"])
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = executed(spark, name)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
