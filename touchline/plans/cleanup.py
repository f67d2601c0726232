"""Season clean-up of raw extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import (
    by_side,
    contains_text,
    decode,
    drop_columns,
    flag_to_int,
    is_marked,
    null_sentinel,
)
from touchline.functions.names import full_name, round_number, url_segment
from touchline.sources.schemas import CLEAN_PLAYER_COLUMNS, ID_LIST_COLUMNS

# Fixed value: text in place of numbers for players who stayed on the bench.
NOT_PLAYED = "On matchday squad, but did not play"


def clean_players(raw_players: DataFrame) -> DataFrame:
    """Wanted player columns with positions by name; an unknown position fails the job."""
    return raw_players.withColumn("element_type", decode(F.col("element_type"))).select(*CLEAN_PLAYER_COLUMNS)


def id_list(raw_players: DataFrame) -> DataFrame:
    return raw_players.select(*ID_LIST_COLUMNS)


def tagged(df: DataFrame, season: str, column: str = "season") -> DataFrame:
    return df.withColumn(column, F.lit(season))


def clean_teams(teams: DataFrame, links: DataFrame, season: str) -> DataFrame:
    """Teams with their id from the team link (name, link)."""
    ids = links.select("name", url_segment(F.col("link"), 3).alias("fbref_id"))
    return tagged(teams, season).join(ids, "name", "left")


def clean_history(merged: DataFrame, season: str) -> DataFrame:
    return drop_columns(tagged(merged, season), ["modified"])


def clean_events(events: DataFrame, season: str) -> DataFrame:
    """League rounds as numbers, bench text as NULL, start and captain flags as numbers."""
    rows = events.where(~contains_text(F.col("Round"), "League"))
    rows = null_sentinel(rows, NOT_PLAYED).withColumn("Round", round_number(F.col("Round")))
    start = F.regexp_replace("Start", r"^Y\*$", "Y")
    return tagged(rows, season, "Season").withColumn("Captain", is_marked(F.col("Start"))).withColumn(
        "Start", flag_to_int(start)
    )


def week_history(histories: DataFrame, players: DataFrame, fixtures: DataFrame, teams: DataFrame) -> DataFrame:
    """History rows with name, position and own team, the team picked from the fixture by side."""
    people = players.select(
        F.col("id").alias("element"),
        full_name(F.col("first_name"), F.col("second_name")).alias("name"),
        decode(F.col("element_type")).alias("position"),
    )
    sides = fixtures.select(F.col("id").alias("fixture"), "team_h", "team_a")
    names = teams.select(F.col("id").alias("_team"), F.col("name").alias("team"))
    own = by_side(F.lower(F.col("was_home").cast("string")) == "true", F.col("team_h"), F.col("team_a"))
    return (
        histories.join(people, "element")
        .join(sides, "fixture")
        .withColumn("_team", own)
        .join(names, "_team")
        .select("name", "position", "team", *histories.columns)
    )
