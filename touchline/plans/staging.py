"""Raw tables to entities with surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import one_if, renamed
from touchline.functions.names import round_number, token
from touchline.operators.aggregates import tenures
from touchline.operators.joins import either_side, valid_at
from touchline.operators.ranking import dense_id
from touchline.operators.sets import columns_of_distinct
from touchline.operators.skew import BROADCAST_PEOPLE, bounded_broadcast

# Source column to entity column.
TEAM_COLUMNS = {"name": "team_name", "short_name": "team_short_name", "fbref_id": "team_fbref_id"}
PLAYER_COLUMNS = {"fpl_f_name": "player_f_name", "fpl_l_name": "player_l_name", "id_fbref": "fbref_id"}
FIXTURE_COLUMNS = {
    "season": "season",
    "event": "game_week",
    "finished": "finished",
    "team_h_score": "home_goals",
    "team_a_score": "away_goals",
    "kickoff_time": "game_date",
    "team_h": "home_id",
    "team_a": "away_id",
    "team_h_difficulty": "home_team_difficulty",
    "team_a_difficulty": "away_team_difficulty",
}
SEASON_COLUMNS = {
    "name": "team_name",
    "season": "season",
    "id": "fpl_season_id",
    "strength_attack_home": "home_attack_score",
    "strength_defence_home": "home_defence_score",
    "strength_attack_away": "away_attack_score",
    "strength_defence_away": "away_defence_score",
}
GAME_SIDE_COLUMNS = {
    "total_points": "points",
    "transfers_in": "transfers_in",
    "transfers_out": "transfers_out",
    "bps": "bonus_point_system",
    "minutes": "minutes",
    "goals_scored": "goals_scored",
    "assists": "assists",
    "clean_sheets": "clean_sheets",
    "goals_conceded": "goals_conceded",
    "own_goals": "own_goals",
    "penalties_saved": "penalties_saved",
    "penalties_missed": "penalties_missed",
    "yellow_cards": "yellow_cards",
    "red_cards": "red_cards",
    "saves": "saves",
    "influence": "influence_score",
    "creativity": "creativity_score",
    "threat": "threat_score",
    "ict_index": "ict_index",
}
EVENT_SIDE_COLUMNS = {
    "Starter": "starter",
    "Pos": "position",
    "Min": "minutes",
    "Performance_Gls": "goals",
    "Performance_Ast": "assists",
    "Performance_PK": "pk_made",
    "Performance_PKatt": "pk_attempt",
    "Performance_Sh": "shots",
    "Performance_SoT": "shots_on_target",
    "Performance_CrdY": "yellow_card",
    "Performance_CrdR": "red_card",
    "Performance_Touches": "touches",
    "Performance_Tkl": "tackles",
    "Performance_Int": "interceptions",
    "Performance_Blocks": "blocks",
    "Expected_xG": "expected_goals",
    "Expected_npxG": "non_pen_expected_goals",
    "Expected_xAG": "expected_assists",
    "SCA_SCA": "shot_creating_actions",
    "SCA_GCA": "goal_creating_actions",
    "Passes_Cmp": "pass_completed",
    "Passes_Att": "pass_attempted",
    "Passes_PrgP": "pass_progressive",
    "Carries_Carries": "carries",
    "Carries_PrgC": "carries_progressive",
    "Take_Ons_Att": "take_ons_attempted",
    "Take_Ons_Succ": "take_ons_success",
    "Performance_SoTA": "shot_on_target_against",
    "Performance_GA": "goals_against",
    "Performance_Saves": "saves",
    "Performance_PSxG": "post_shot_expected_goals",
    "Captain": "captain",
}


def teams(raw_team_data: DataFrame) -> DataFrame:
    return dense_id(renamed(raw_team_data, TEAM_COLUMNS).distinct(), ["team_name"], "team_id")


def players(raw_compiled_ids: DataFrame) -> DataFrame:
    distinct = renamed(raw_compiled_ids, PLAYER_COLUMNS).distinct()
    return dense_id(distinct, ["player_f_name", "player_l_name"], "player_id")


def fixtures(raw_fixtures: DataFrame) -> DataFrame:
    """Fixtures without a game week come last within their season."""
    return dense_id(
        renamed(raw_fixtures, FIXTURE_COLUMNS), ["season", "game_week", "home_id", "away_id"], "fix_id"
    )


def fpl_player(players: DataFrame, raw_players_clean: DataFrame) -> DataFrame:
    seasons = raw_players_clean.select(
        F.col("first_name").alias("player_f_name"),
        F.col("second_name").alias("player_l_name"),
        F.col("element_type").alias("position"),
        "season",
    )
    joined = players.join(seasons, ["player_f_name", "player_l_name"]).select("player_id", "position", "season")
    return dense_id(joined, ["player_id"], "fpl_player_id")


def team_season_info(teams: DataFrame, raw_team_data: DataFrame) -> DataFrame:
    seasons = renamed(raw_team_data, SEASON_COLUMNS)
    return teams.select("team_name", "team_id").join(seasons, "team_name").drop("team_name")


def team_fixtures(fixtures: DataFrame) -> DataFrame:
    """Fixtures once per side, keyed by the season's team id."""
    return either_side(fixtures, "home_id", "away_id", "fpl_season_id")


def plays(raw_players_clean: DataFrame, team_season_info: DataFrame, fixtures: DataFrame, players: DataFrame) -> DataFrame:
    """Tenures inferred from the fixtures of each season's team; open while the team still plays."""
    squads = raw_players_clean.select(
        F.col("first_name").alias("player_f_name"),
        F.col("second_name").alias("player_l_name"),
        F.col("team").alias("fpl_season_id"),
        "season",
    )
    # First and last date per team and season first: the join then carries two dates per squad place.
    dates = (
        team_fixtures(fixtures)
        .groupBy("season", "fpl_season_id")
        .agg(F.min("game_date").alias("first_date"), F.max("game_date").alias("last_date"))
    )
    places = (
        squads.join(team_season_info.select("team_id", "season", "fpl_season_id"), ["season", "fpl_season_id"])
        .join(dates, ["season", "fpl_season_id"])
        .join(players.select("player_id", "player_f_name", "player_l_name"), ["player_f_name", "player_l_name"])
    )
    dated = places.select("player_id", "team_id", F.explode(F.array("first_date", "last_date")).alias("game_date"))
    return tenures(dated, ["player_id", "team_id"], "game_date", fixtures.agg(F.max("game_date")).scalar())


def fpl_performance(
    raw_fpl_performance: DataFrame,
    teams: DataFrame,
    team_season_info: DataFrame,
    fixtures: DataFrame,
    players: DataFrame,
    fpl_player: DataFrame,
) -> DataFrame:
    """Game-side statistics per player and fixture, by team, calendar day and two-token name."""
    history = raw_fpl_performance.select(
        F.col("team").alias("team_name"),
        "season",
        F.to_date("kickoff_time").alias("day"),
        token(F.col("name"), 1).alias("player_f_name"),
        token(F.col("name"), 2).alias("player_l_name"),
        (F.col("value") / 10).alias("price"),
        *[F.col(source).alias(label) for source, label in GAME_SIDE_COLUMNS.items()],
    )
    own = team_season_info.join(teams.select("team_id", "team_name"), "team_id")
    own = own.select("team_name", "season", "fpl_season_id")
    played = team_fixtures(fixtures).select("fix_id", "fpl_season_id", F.to_date("game_date").alias("day"))
    person = players.join(fpl_player.select("player_id", "fpl_player_id", "season"), "player_id")
    person = person.select("player_f_name", "player_l_name", "season", "fpl_player_id")
    return (
        history.join(own, ["team_name", "season"])
        .join(played, ["fpl_season_id", "day"])
        .join(person, ["player_f_name", "player_l_name", "season"])
        .select("fpl_player_id", "fix_id", "price", *GAME_SIDE_COLUMNS.values())
        .distinct()
    )


def real_performance(
    raw_real_perf: DataFrame,
    raw_compiled_ids: DataFrame,
    players: DataFrame,
    plays: DataFrame,
    team_season_info: DataFrame,
    fixtures: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Event-side statistics per player and fixture, by name, tenure at the date, and round.

    People and tenures are broadcast while they are few, and rows are dealt by player
    once, for the distinct rows and for any window over a player that follows. With
    ``columns``, player and fixture among them, the distinct rows give those alone: whole
    rows are then shuffled only where a player has several in a fixture.
    """
    rows = raw_real_perf.select(
        F.col("Name").alias("fbref_name"),
        F.col("Date").alias("date"),
        F.col("Season").alias("season"),
        round_number(F.col("Round").cast("string")).alias("game_week"),
        *[F.col(source).alias(label) for source, label in EVENT_SIDE_COLUMNS.items()],
        one_if(F.col("Performance_CS") == 1).alias("clean_sheets"),
    )
    people = raw_compiled_ids.select(
        "fbref_name", F.col("fpl_f_name").alias("player_f_name"), F.col("fpl_l_name").alias("player_l_name")
    ).join(players.select("player_id", "player_f_name", "player_l_name"), ["player_f_name", "player_l_name"])
    people = bounded_broadcast(people.select("fbref_name", "player_id"), BROADCAST_PEOPLE)
    tenure = plays.select("player_id", "team_id", "start_date", "end_date")
    own = team_season_info.select("team_id", "season", "fpl_season_id")
    played = team_fixtures(fixtures).select("fix_id", "season", "game_week", "fpl_season_id")
    found = (
        valid_at(rows.join(people, "fbref_name"), bounded_broadcast(tenure, BROADCAST_PEOPLE), "player_id", "date")
        .join(own, ["team_id", "season"])
        .join(played, ["season", "game_week", "fpl_season_id"])
        .select("player_id", "fix_id", *EVENT_SIDE_COLUMNS.values(), "clean_sheets")
    )
    if columns is not None:
        return columns_of_distinct(found, ["player_id", "fix_id"], columns)
    return found.repartition("player_id").distinct()
