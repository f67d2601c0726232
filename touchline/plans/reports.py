"""Predictions beside what happened."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import clip_at_zero, confusion_class, goal_points
from touchline.functions.names import full_name
from touchline.operators.ranking import ranked
from touchline.operators.skew import BROADCAST_PEOPLE, bounded_broadcast

RANK_GROUP = ["season", "position", "game_week"]


def _predicted_and_actual(predictions: DataFrame, fixtures: DataFrame, real_performance: DataFrame) -> DataFrame:
    when = fixtures.select(F.col("fix_id").alias("fixture_id"), "game_week", "season")
    actual = real_performance.select("player_id", F.col("fix_id").alias("fixture_id"), "goals", "assists")
    return (
        predictions.select("player_id", "fixture_id", "predicted_goals", "predicted_assists")
        .join(actual, ["player_id", "fixture_id"])
        .join(when, "fixture_id")
    )


def _named(rows: DataFrame, players: DataFrame) -> DataFrame:
    """Rows with the player's name, the last join, so that no exchange before it carries names."""
    names = players.select("player_id", full_name(F.col("player_f_name"), F.col("player_l_name")).alias("player_name"))
    return rows.join(bounded_broadcast(names, BROADCAST_PEOPLE), "player_id")


def prediction_analysis(
    predictions: DataFrame, players: DataFrame, fixtures: DataFrame, real_performance: DataFrame
) -> DataFrame:
    """Predicted and actual goals and assists per player and fixture."""
    rows = _named(_predicted_and_actual(predictions, fixtures, real_performance), players)
    return rows.select(
        "player_name", "game_week", "season", "goals", "predicted_goals", "assists", "predicted_assists"
    )


def with_points(df: DataFrame) -> DataFrame:
    """Actual and predicted points by position; predictions below zero count as zero."""
    return df.withColumn("points", goal_points(F.col("position"), F.col("goals"), F.col("assists"))).withColumn(
        "predicted_points",
        goal_points(
            F.col("position"), clip_at_zero(F.col("predicted_goals")), clip_at_zero(F.col("predicted_assists"))
        ),
    )


def with_ranks(df: DataFrame, tie: list[str], k: int = 10) -> DataFrame:
    """Ranks by predicted and by actual points in each group and week, and the prediction's class.

    Predicted ranks come last: their rows then lie in report order, which is quickly sorted again.
    """
    ties = [F.asc_nulls_last(c) for c in tie]
    by = {"actual_rank": "points", "predicted_rank": "predicted_points"}
    with_both = ranked(df, RANK_GROUP, {name: [F.desc_nulls_last(c), *ties] for name, c in by.items()})
    return with_both.select(*df.columns, "predicted_rank", "actual_rank").withColumn("prediction_accuracy", confusion_class(F.col("predicted_rank"), F.col("actual_rank"), k))


def prediction_accuracy(
    predictions: DataFrame,
    players: DataFrame,
    fixtures: DataFrame,
    real_performance: DataFrame,
    fpl_player: DataFrame,
    k: int = 10,
) -> DataFrame:
    """Ranked accuracy report in report order; one range exchange serves the ranks and that order."""
    positions = fpl_player.select("player_id", "season", "position")
    rows = _predicted_and_actual(predictions, fixtures, real_performance).join(positions, ["player_id", "season"])
    rows = _named(rows, players).repartitionByRange(*RANK_GROUP)
    report = with_ranks(with_points(rows), ["player_id", "fixture_id", "predicted_goals", "predicted_assists"], k)
    return report.select(
        "player_name", "position", "game_week", "season", "points", "predicted_points",
        "predicted_rank", "actual_rank", "prediction_accuracy",
    ).orderBy("season", "position", "game_week", "predicted_rank")
