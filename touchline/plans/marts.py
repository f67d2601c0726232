"""Fixture, team and player feature tables, training and scoring matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import by_side, one_if
from touchline.functions.names import full_name
from touchline.operators.aggregates import max_where
from touchline.operators.joins import role_playing, unpivot_sides, valid_at
from touchline.operators.ranking import keep_first
from touchline.operators.skew import BROADCAST_PEOPLE, bounded_broadcast
from touchline.operators.windows import carry_to_next_period
from touchline.plans.features import (
    add_formulas,
    formula_names,
    roll_stats,
    roll_team,
    rolled_names,
    team_names,
)
from touchline.plans.staging import team_fixtures

# Least minutes before a player's row is used.
MIN_MINUTES = 90
MIN_MATRIX_MINUTES = 60


def fixture_names(fixtures: DataFrame, team_season_info: DataFrame, teams: DataFrame) -> DataFrame:
    """Fixtures with both teams' names."""
    named = team_season_info.join(teams, "team_id").select("season", "fpl_season_id", "team_name")
    sides = fixtures.withColumns(
        {
            "home_key": F.struct("season", F.col("home_id").alias("fpl_season_id")),
            "away_key": F.struct("season", F.col("away_id").alias("fpl_season_id")),
        }
    )
    dim = named.select(F.struct("season", "fpl_season_id").alias("key"), "team_name")
    joined = role_playing(sides, dim, {"home": "home_key", "away": "away_key"}, "key", ["team_name"])
    return joined.select(
        "fix_id",
        "season",
        "finished",
        "home_team_name",
        "away_team_name",
        "home_goals",
        "away_goals",
        "home_team_difficulty",
        "away_team_difficulty",
        "game_date",
    )


def _team_goals(fixtures: DataFrame, team_season_info: DataFrame) -> DataFrame:
    rows = unpivot_sides(
        fixtures,
        ["fix_id", "season", "game_week"],
        {
            "home": {"fpl_season_id": "home_id", "team_goals_scored": "home_goals", "team_goals_conceded": "away_goals"},
            "away": {"fpl_season_id": "away_id", "team_goals_scored": "away_goals", "team_goals_conceded": "home_goals"},
        },
        "match_location",
    )
    return rows.join(team_season_info.select("team_id", "season", "fpl_season_id"), ["season", "fpl_season_id"])


def team_pre_match(fixtures: DataFrame, team_season_info: DataFrame) -> DataFrame:
    """Goals before each fixture, per team."""
    rolled = roll_team(_team_goals(fixtures, team_season_info))
    return rolled.select("team_id", "fix_id", "season", "game_week", "match_location", *team_names())


def last_finished_week(fixtures: DataFrame, season: str) -> Column:
    return max_where(fixtures, F.col("finished") & (F.col("season") == season), "game_week")


def next_fixtures(fixtures: DataFrame, team_season_info: DataFrame, season: str) -> DataFrame:
    """(fix_id, team_id, ..) of the week after the last finished one."""
    week = last_finished_week(fixtures, season) + 1
    upcoming = fixtures.where((F.col("season") == season) & (F.col("game_week") == week))
    own = team_season_info.select("team_id", "season", "fpl_season_id")
    return team_fixtures(upcoming).join(own, ["season", "fpl_season_id"])


def team_next_match(
    fixtures: DataFrame, team_season_info: DataFrame, season: str, compat: bool = False
) -> DataFrame:
    """Goals before each team's next fixture.

    With ``compat`` a team with two fixtures in the week gets every row once per
    fixture, as a join by team alone would give.
    """
    week = last_finished_week(fixtures, season) + 1
    known = fixtures.where((F.col("season") == season) & (F.col("game_week") <= week))
    rolled = roll_team(_team_goals(known, team_season_info)).where(F.col("game_week") == week)
    if compat:
        rolled = rolled.join(next_fixtures(fixtures, team_season_info, season).select("team_id"), "team_id")
    return rolled.select("team_id", "fix_id", "season", "game_week", "match_location", *team_names())


def _with_strengths(df: DataFrame, team_season_info: DataFrame, compat: bool) -> DataFrame:
    """Side, opponent and both strengths for rows with (team_id, season, home_id, away_id).

    Team strength uses home scores and opponent strength away scores, whatever the
    side. The opponent is found by its season id; ``compat`` compares it with the
    surrogate key instead.
    """
    own = team_season_info.select(
        "team_id",
        "season",
        "fpl_season_id",
        (F.col("home_attack_score") + F.col("home_defence_score")).alias("team_strength"),
    )
    other = team_season_info.select(
        F.col("team_id" if compat else "fpl_season_id").alias("opponent_team_id"),
        "season",
        (F.col("away_attack_score") + F.col("away_defence_score")).alias("opponent_strength"),
    )
    at_home = F.col("home_id") == F.col("fpl_season_id")
    return (
        df.join(own, ["team_id", "season"])
        .withColumn("home_or_away", one_if(at_home))
        .withColumn("opponent_team_id", by_side(at_home, F.col("away_id"), F.col("home_id")))
        .join(other, ["opponent_team_id", "season"])
    )


# Labels of the matrix and the statistics they are.
LABELS = {"label_goals": "goals", "label_assists": "assists"}
ID_COLUMNS = [
    "player_name", "player_id", "fix_id", "game_week", "season", "team_id", "home_or_away",
    "opponent_team_id", "team_strength", "opponent_strength",
]


def _outfield(real_performance: DataFrame, players: DataFrame, fixtures: DataFrame, plays: DataFrame) -> DataFrame:
    """Outfield rows with fixture, name and the team at the time of the fixture.

    Names and tenures are broadcast while they are few, so rows dealt by player stay so.
    """
    names = players.select("player_id", full_name(F.col("player_f_name"), F.col("player_l_name")).alias("player_name"))
    when = fixtures.select("fix_id", "game_week", "season", "game_date", "home_id", "away_id")
    rows = real_performance.where(F.col("position") != "GK").join(when, "fix_id")
    rows = rows.join(bounded_broadcast(names, BROADCAST_PEOPLE), "player_id")
    tenure = bounded_broadcast(plays.select("player_id", "team_id", "start_date", "end_date"), BROADCAST_PEOPLE)
    return valid_at(rows, tenure, "player_id", "game_date")


def player_pre_match(
    real_performance: DataFrame,
    players: DataFrame,
    fixtures: DataFrame,
    plays: DataFrame,
    team_season_info: DataFrame,
    min_minutes: int = MIN_MINUTES,
    compat: bool = False,
    labels: bool = False,
) -> DataFrame:
    """Each outfield player's form before each fixture played, 125 columns, with ``labels`` the two of the row itself."""
    rows = _with_strengths(_outfield(real_performance, players, fixtures, plays), team_season_info, compat)
    rolled = roll_stats(rows, ["player_id", "season"], ["game_week", "fix_id", "team_id"])
    used = rolled.where(F.col("rolling_ub_minutes") >= min_minutes)
    own = [F.col(source).alias(label) for label, source in LABELS.items()] if labels else []
    return add_formulas(used).select(*ID_COLUMNS, *rolled_names(), *formula_names(), *own)


def player_next_match(
    real_performance: DataFrame,
    players: DataFrame,
    fixtures: DataFrame,
    plays: DataFrame,
    team_season_info: DataFrame,
    season: str,
    latest_row: bool = False,
    literal_frames: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Each outfield player's form before the next fixture, 125 columns.

    Players need a row in the last finished week; with ``latest_row`` their latest
    row up to that week counts. ``literal_frames`` keeps frames one row longer than
    named; ``compat`` finds the opponent's strength by surrogate key.
    """
    this_season = fixtures.where(F.col("season") == season)
    rows = _outfield(real_performance, players, this_season, plays)
    rolled = roll_stats(rows, ["player_id", "season"], ["game_week", "fix_id", "team_id"], True, literal_frames)
    if latest_row:
        week = last_finished_week(fixtures, season)
        rolled = keep_first(
            rolled.where(F.col("game_week") <= week),
            ["player_id", "season"],
            [F.desc("game_week"), F.desc("fix_id"), F.desc("team_id")],
        ).withColumn("game_week", week)
    form = carry_to_next_period(rolled, "game_week").select(
        "player_id", "player_name", "season", "game_week", "team_id", *rolled_names()
    )
    coming = next_fixtures(fixtures, team_season_info, season).select(
        "fix_id", "season", "game_week", "team_id", "game_date", "home_id", "away_id"
    )
    joined = coming.join(form, ["team_id", "season", "game_week"]).withColumnRenamed("team_id", "form_team_id")
    at_fixture = valid_at(joined, plays.select("player_id", "team_id", "start_date", "end_date"), "player_id", "game_date")
    strengths = _with_strengths(at_fixture, team_season_info, compat)
    named = strengths.withColumn("team_id", F.col("form_team_id"))
    return add_formulas(named).select(*ID_COLUMNS, *rolled_names(), *formula_names())


MATRIX_IDS = ["player_id", "fix_id", "game_week", "season", "team_strength", "opponent_strength"]


def modeling_matrix(
    pre_match: DataFrame,
    real_performance: DataFrame | None,
    team_pre: DataFrame,
    min_minutes: int = MIN_MATRIX_MINUTES,
) -> DataFrame:
    """Labels and features of played fixtures, 129 columns.

    Without ``real_performance`` the labels are columns of ``pre_match``, which spares
    a join of all its columns.
    """
    rows = pre_match.where(F.col("rolling_ub_minutes") >= min_minutes)
    if real_performance is not None:
        own = [F.col(source).alias(label) for label, source in LABELS.items()]
        rows = rows.join(real_performance.select("player_id", "fix_id", *own), ["player_id", "fix_id"])
    team = bounded_broadcast(team_pre.select("team_id", "fix_id", *team_names()))
    joined = rows.join(team, ["team_id", "fix_id"])
    return joined.select(*LABELS, *MATRIX_IDS, *rolled_names(), *formula_names(), *team_names())


def scoring_matrix(
    next_match: DataFrame,
    team_next: DataFrame,
    real_performance: DataFrame | None = None,
    min_minutes: int = MIN_MATRIX_MINUTES,
) -> DataFrame:
    """Features of the next fixtures, 127 columns, distinct.

    Given ``real_performance`` only fixtures already played are kept, which is what
    an inner join to that table does.
    """
    rows = next_match.where(F.col("rolling_ub_minutes") >= min_minutes)
    if real_performance is not None:
        rows = rows.join(real_performance.select("player_id", "fix_id"), ["player_id", "fix_id"], "left_semi")
    team = bounded_broadcast(team_next.select("team_id", "fix_id", *team_names()))
    joined = rows.join(team, ["team_id", "fix_id"])
    return joined.select(*MATRIX_IDS, *rolled_names(), *formula_names(), *team_names()).distinct()
