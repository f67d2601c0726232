"""Every query against its SQL on the smallest tables, and plans of the headline ones."""

import re

import pytest
from oracle import check

from touchline.queries import ORACLES, QUERIES
from touchline.queries.seasons import Season

SF = "/root/testdata/sf0.001"
# Fits of whole models are covered in test_modelling.
SLOW = {"outlier_filter", "model_search", "batch_score", "drift_check"}
# No row of the smallest tables reaches the next fixtures or keys.
EMPTY = {"player_next_form", "player_next_form_literal", "next_matrix"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_agrees_with_its_sql(spark, name):
    problems, rows = check(spark, name, SF)
    assert not problems
    assert rows or name in EMPTY


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert {n for n in QUERIES if n not in ORACLES} == SLOW


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    pit = plan_of(spark, "point_in_time_join")
    assert "NestedLoop" not in pit and "Cartesian" not in pit
    capped = plan_of(spark, "capped_topk")
    assert "WindowGroupLimit" in capped.split("Exchange")[-1], "groups are cut before the exchange"
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    dims = plan_of(spark, "dim_join")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in dims, "filters reach the scan"
    rates = plan_of(spark, "rolling_rates")
    assert rates.count("Exchange hashpartitioning") == 2, "one exchange for the sums and one for all windows"
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:" in rates


def test_wide_rows_are_dealt_once(spark):
    """Lines by supplier, then rows by player: names, tenures, labels and team form join them where they are."""
    plan = plan_of(spark, "training_matrix").split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning(player_id") == 1
    assert "SortMergeJoin" not in plan
    for name in ("player_form", "player_next_form", "staged_event_side"):
        assert plan_of(spark, name).count("Exchange hashpartitioning(player_id") == 1, name


def test_report_is_ranked_in_report_order(spark):
    """Ranks and the report's order share one range exchange, which alone carries names."""
    plan = plan_of(spark, "prediction_report").split("== Initial Plan ==")[-1]
    assert plan.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning(position" not in plan and "Exchange hashpartitioning(season" not in plan


def test_reports_shuffle_the_columns_they_use(spark):
    season = Season(spark, SF)
    assert "yellow_card" not in str(season.results._jdf.queryExecution().executedPlan().toString())
    expected = season.event_side.select("player_id", "fix_id", "goals", "assists")
    assert sorted(map(tuple, season.results.collect())) == sorted(map(tuple, expected.collect()))


def test_next_matches_deal_one_season(spark):
    """Rows of other seasons are left out where they are read, not after they are dealt by player."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name in ("player_next_form", "player_next_form_latest", "next_matrix"):
        dealt = plan_of(spark, name).split("== Initial Plan ==")[-1].split("Exchange hashpartitioning(player_id")[1]
        assert re.search(r"Filter .*lpad\(.* = 2000-01\)", dealt), name
    spark.conf.unset("spark.sql.maxMetadataStringLength")
