"""Column decoding, clean-up and season labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.columns import (
    POSITIONS,
    clip_at_zero,
    columns_of,
    contains_text,
    decode,
    drop_columns,
    flag_to_int,
    is_marked,
    lower_names,
    null_sentinel,
    one_if,
    renamed,
)
from touchline.functions.names import round_number
from touchline.functions.seasons import is_season, long_season, previous_season, season_end, season_of, season_start
from touchline.plans.cleanup import NOT_PLAYED, clean_events, clean_teams
from touchline.queries.registry import query, table


@query(
    """
    SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'GK' WHEN '2' THEN 'DEF' WHEN '3' THEN 'MID' WHEN '4' THEN 'FWD' ELSE 'MNG' END AS position
    FROM orders
    """
)
def enum_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {**POSITIONS, "5": "MNG"}
    position = decode(F.substring("o_orderpriority", 1, 1), names)
    return table(spark, sf_dir, "orders").select("o_orderkey", position.alias("position"))


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS start,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS captain,
           CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS large
    FROM orders
    """
)
def flag_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        flag_to_int(F.col("o_orderstatus"), "F", "O").alias("start"),
        is_marked(F.col("o_orderpriority"), "1-URGENT").alias("captain"),
        one_if(F.col("o_totalprice") > 100000).alias("large"),
    )


@query(
    """
    SELECT event_id, NULLIF(event_type, 'error') AS event_type, NULLIF(props, 'error') AS props,
           GREATEST(value - 50, 0) AS clipped, value / 10 AS price
    FROM events
    """
)
def sentinel_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = null_sentinel(table(spark, sf_dir, "events"), "error")
    return events.select(
        "event_id", "event_type", "props",
        clip_at_zero(F.col("value") - 50).alias("clipped"), (F.col("value") / 10).alias("price"),
    )


@query("SELECT o_orderkey AS key, o_totalprice AS price, o_custkey AS customer FROM orders")
def type_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number columns only, renamed, after dropping by name and by position."""
    orders = drop_columns(table(spark, sf_dir, "orders"), ["o_orderstatus", "not_there"], [-1])
    numbers = orders.select(*columns_of(orders, "number"))
    upper = numbers.toDF(*[c.upper() for c in numbers.columns])
    return renamed(lower_names(upper), {"o_orderkey": "key", "o_totalprice": "price", "o_custkey": "customer"})


SEASON_SQL = "(YEAR(o_orderdate) - CASE WHEN MONTH(o_orderdate) >= 8 THEN 0 ELSE 1 END)"


@query(
    f"""
    SELECT o_orderkey,
           printf('%d-%02d', start, (start + 1) % 100) AS season, printf('%d-%02d', start - 1, start % 100) AS previous,
           CAST(start AS INTEGER) AS start_year, CAST(start + 1 AS INTEGER) AS end_year,
           printf('%d-%d', start, start + 1) AS long_form, TRUE AS valid, FALSE AS date_valid
    FROM (SELECT o_orderkey, {SEASON_SQL} AS start FROM orders)
    """
)
def season_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = F.col("season")
    orders = table(spark, sf_dir, "orders").withColumn("season", season_of(F.col("o_orderdate")))
    return orders.select(
        "o_orderkey",
        "season",
        previous_season(season).alias("previous"),
        season_start(season).alias("start_year"),
        season_end(season).alias("end_year"),
        long_season(season).alias("long_form"),
        is_season(season).alias("valid"),
        is_season(F.col("o_orderdate").cast("string")).alias("date_valid"),
    )


@query(
    f"""
    SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN MONTH(o_orderdate) END AS INTEGER) AS Round,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 0 END AS Start,
           NULLIF(CASE WHEN o_orderpriority = '5-LOW' THEN '{NOT_PLAYED}' ELSE CAST(o_custkey AS VARCHAR) END, '{NOT_PLAYED}') AS Min,
           '1999-00' AS Season, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS Captain
    FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
    """
)
def season_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw event rows: bad rounds, league cup rows, bench text and start marks."""
    priority = F.col("o_orderpriority")
    week = F.month("o_orderdate")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(priority == "4-NOT SPECIFIED", "Champions League Final")
        .when(F.col("o_orderstatus") == "P", "Matchweek ?")
        .otherwise(F.concat(F.lit("Matchweek "), week))
        .alias("Round"),
        F.when(priority == "1-URGENT", "Y*").when(priority == "2-HIGH", "Y").when(priority == "3-MEDIUM", "N").otherwise("?").alias("Start"),
        F.when(priority == "5-LOW", NOT_PLAYED).otherwise(F.col("o_custkey").cast("string")).alias("Min"),
    )
    return clean_events(raw, "1999-00")


@query("SELECT n_name AS name, n_regionkey AS id, '2024-25' AS season, 'h' || n_nationkey AS fbref_id FROM nation")
def team_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    links = nations.select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("https://stats.example.org/en/squads/h"), "n_nationkey", F.lit("/"), "n_name", F.lit("-Stats")).alias("link"),
    )
    teams = nations.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("id"))
    return clean_teams(teams, links, "2024-25")


@query("SELECT p_partkey, CAST(regexp_extract(p_brand, '[0-9]+$') AS INTEGER) AS brand, contains(p_name, 'bolt') AS bolt, contains(lower(p_type), 'mo') AS promo FROM part")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        round_number(F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("brand"),
        contains_text(F.col("p_name"), "bolt").alias("bolt"),
        contains_text(F.col("p_type"), "Mo", ignore_case=True).alias("promo"),
    )
