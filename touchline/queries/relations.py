"""Surrogate keys, set operations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.columns import by_side
from touchline.functions.names import token
from touchline.operators.aggregates import tenures
from touchline.operators.joins import (
    drop_keys,
    either_side,
    fill_from_previous,
    keep_keys,
    latest_attribute,
    on_same_day,
    role_playing,
    split_matched,
    valid_at,
)
from touchline.operators.ranking import dense_id, keep_first
from touchline.operators.sets import common_rows, missing_rows, outer_union, union_distinct
from touchline.queries.registry import exact, month_index, plain, query, table
from touchline.queries.rolling import TRADE_MATCHES_SQL, trade_matches


@query(
    """
    SELECT ROW_NUMBER() OVER (ORDER BY p_brand, p_type) AS type_id, p_brand, p_type
    FROM (SELECT DISTINCT p_brand, p_type FROM part)
    """
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    return dense_id(types, ["p_brand", "p_type"], "type_id")


@query("SELECT ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id, o_orderkey, o_orderdate FROM orders")
def order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dense_id(orders, ["o_orderdate", "o_orderkey"], "order_id")


@query(
    """
    SELECT p_partkey, p_brand, p_type, p_name FROM part
    QUALIFY ROW_NUMBER() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1
    """
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return keep_first(part, ["p_brand", "p_type"], [F.asc("p_partkey")])


@query(
    """
    SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer
    UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier
    """
)
def union_distinct_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("label"))
    return union_distinct(customers, suppliers)


@query(
    """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """
)
def outer_schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return outer_union(customers, suppliers)


@query(
    """
    SELECT 'without_orders' AS found, key FROM (SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders)
    UNION ALL
    SELECT 'in_both', key FROM (SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders)
    """
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    without = missing_rows(customers, orders).select(F.lit("without_orders").alias("found"), "key")
    both = common_rows(customers, orders).select(F.lit("in_both").alias("found"), "key")
    return without.unionByName(both)


@query(
    """
    SELECT l_suppkey, l_partkey, MIN(l_shipdate) AS start_date,
           CASE WHEN MAX(l_shipdate) < (SELECT MAX(l_shipdate) FROM lineitem) THEN MAX(l_shipdate) END AS end_date
    FROM lineitem GROUP BY l_suppkey, l_partkey
    """
)
def tenure_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    return tenures(lines, ["l_suppkey", "l_partkey"], "l_shipdate", lines.agg(F.max("l_shipdate")).scalar())


# A user's tenure in an event type: from the first such event to the last one outside the last day.
TENURE_SQL = """
    SELECT user_id, event_type AS tenure, MIN(ts) AS start_date,
           CASE WHEN MAX(ts) < (SELECT CAST(CAST(MAX(ts) AS DATE) AS TIMESTAMP) FROM events) THEN MAX(ts) END AS end_date
    FROM events GROUP BY user_id, event_type
"""


@query(
    f"""
    WITH tenures AS ({TENURE_SQL})
    SELECT event_id, events.user_id, tenure, start_date, end_date FROM events JOIN tenures
    ON events.user_id = tenures.user_id AND ts BETWEEN start_date AND COALESCE(end_date, TIMESTAMP '9999-12-31')
    """
)
def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    last_day = events.agg(F.max("ts").cast("date").cast("timestamp_ntz")).scalar()
    spans = tenures(events.withColumnRenamed("event_type", "tenure"), ["user_id", "tenure"], "ts", last_day)
    return valid_at(events.drop("event_type"), spans, "user_id", "ts").drop("ts")


@query(
    f"""
    WITH matches AS ({TRADE_MATCHES_SQL})
    SELECT n_nationkey, n_name, season, game_week, home_id, away_id, CAST(home_goals AS DOUBLE) AS home_goals
    FROM nation JOIN matches ON n_nationkey = home_id OR n_nationkey = away_id
    """
)
def either_side_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = either_side(trade_matches(spark, sf_dir), "home_id", "away_id", "n_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nations.join(sides, "n_nationkey").select(
        "n_nationkey", "n_name", "season", "game_week", "home_id", "away_id", plain("home_goals").alias("home_goals")
    )


@query(
    f"""
    WITH matches AS ({TRADE_MATCHES_SQL}),
    sides AS (SELECT t.n_nationkey AS team, m.*, CASE WHEN m.home_id = t.n_nationkey THEN 1 ELSE 0 END AS home_or_away
              FROM nation t JOIN matches m ON t.n_nationkey = m.home_id OR t.n_nationkey = m.away_id)
    SELECT team, home_or_away, season, game_week, opp.n_nationkey AS opponent, opp.n_name AS opponent_name
    FROM sides JOIN nation opp ON opp.n_nationkey = CASE WHEN home_id = team THEN away_id ELSE home_id END
    """
)
def opponent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = either_side(trade_matches(spark, sf_dir), "home_id", "away_id", "team")
    at_home = F.col("home_id") == F.col("team")
    sides = sides.withColumn("opponent", by_side(at_home, F.col("away_id"), F.col("home_id")))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("opponent"), F.col("n_name").alias("opponent_name")
    )
    return sides.join(nations, "opponent").select(
        "team", F.when(at_home, 1).otherwise(0).alias("home_or_away"), "season", "game_week", "opponent", "opponent_name"
    )


@query(
    f"""
    WITH matches AS ({TRADE_MATCHES_SQL})
    SELECT season, game_week, home_id, away_id, h.n_name AS home_n_name, h.n_regionkey AS home_n_regionkey,
           a.n_name AS away_n_name, a.n_regionkey AS away_n_regionkey
    FROM matches JOIN nation h ON h.n_nationkey = home_id JOIN nation a ON a.n_nationkey = away_id
    """
)
def role_playing_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = trade_matches(spark, sf_dir).drop("home_goals", "away_goals")
    nations = table(spark, sf_dir, "nation")
    return role_playing(matches, nations, {"home": "home_id", "away": "away_id"}, "n_nationkey", ["n_name", "n_regionkey"])


@query(
    """
    SELECT o_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS day, CAST(l_quantity AS DOUBLE) AS l_quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    AND CAST(l_shipdate AS DATE) = CAST(o_orderdate + INTERVAL 30 DAY AS DATE)
    """
)
def date_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    due = F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")
    same = (F.col("o_orderkey") == F.col("l_orderkey")) & on_same_day(F.col("l_shipdate"), due)
    return orders.join(lines, same).select(
        "o_orderkey", "l_linenumber", "l_partkey", F.to_date("o_orderdate").alias("day"), "l_quantity"
    )


@query(
    """
    WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS f_name, split_part(p_name, ' ', 2) AS l_name FROM part),
    people AS (SELECT ROW_NUMBER() OVER (ORDER BY f_name, l_name) AS player_id, f_name, l_name FROM words)
    SELECT p_partkey, player_id, p_name FROM part
    JOIN people ON f_name = split_part(p_name, ' ', 1) AND l_name = split_part(p_name, ' ', 2)
    """
)
def token_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    part = part.withColumn("f_name", token(F.col("p_name"), 1)).withColumn("l_name", token(F.col("p_name"), 2))
    people = dense_id(part.select("f_name", "l_name").distinct(), ["f_name", "l_name"], "player_id")
    return part.join(people, ["f_name", "l_name"]).select("p_partkey", "player_id", "p_name")


@query(
    """
    SELECT o_orderkey, c_name, n_name, o_orderpriority AS priority, CAST(o_totalprice AS DOUBLE) AS price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderpriority <> '5-LOW' AND o_totalprice >= 1000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
      AND NOT contains(o_orderpriority, 'NOT')
    """
)
def dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") != "5-LOW")
        & (F.col("o_totalprice") >= 1000)
        & ~F.contains("o_orderpriority", F.lit("NOT"))
    )
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    nations = table(spark, sf_dir, "nation")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey", "c_name", "n_name",
            F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"),
        )
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, n_name AS team
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON n_nationkey = CASE WHEN l_returnflag = 'R' THEN s_nationkey ELSE c_nationkey END
    """
)
def conditional_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("team"))
    own = by_side(F.col("l_returnflag") == "R", F.col("s_nationkey"), F.col("c_nationkey"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("n_nationkey", own)
        .join(nations, "n_nationkey")
        .select(*lines.columns, "team")
    )


@query(
    """
    WITH history AS (SELECT o_custkey, o_totalprice, YEAR(o_orderdate) * 12 + MONTH(o_orderdate) AS period FROM orders),
    sums AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM history GROUP BY 1)
    SELECT sums.o_custkey, total, latest.o_totalprice
    FROM sums LEFT JOIN (SELECT * FROM history WHERE period = (SELECT MAX(period) FROM history)) latest
    ON sums.o_custkey = latest.o_custkey
    """
)
def latest_attr_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", month_index("o_orderdate").alias("period"))
    sums = history.groupBy("o_custkey").agg(plain(F.sum(exact("o_totalprice"))).alias("total"))
    return latest_attribute(sums, history, "o_custkey", "period", ["o_totalprice"])


@query(
    """
    WITH names AS (SELECT DISTINCT p_name, p_brand FROM part),
    ids AS (SELECT p_name, p_brand, MIN(p_partkey) AS found_id FROM part WHERE p_size <= 25 GROUP BY 1, 2)
    SELECT names.p_name, names.p_brand, found_id, CASE WHEN found_id IS NULL THEN 'missing' ELSE 'matched' END AS state
    FROM names LEFT JOIN ids ON names.p_name = ids.p_name AND names.p_brand = ids.p_brand
    """
)
def exact_match_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names = part.select("p_name", "p_brand").distinct()
    ids = part.where("p_size <= 25").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("found_id"))
    matched, missing = split_matched(names, ids, ["p_name", "p_brand"], "found_id")
    return matched.withColumn("state", F.lit("matched")).unionByName(missing.withColumn("state", F.lit("missing")))


@query(
    """
    WITH names AS (SELECT DISTINCT p_name, p_brand FROM part),
    ids AS (SELECT p_name, p_brand, MIN(p_partkey) AS found_id FROM part WHERE p_size <= 25 GROUP BY 1, 2),
    previous AS (SELECT p_name, p_brand, MAX(p_partkey) AS found_id FROM part WHERE p_size > 20 AND p_size <= 40 GROUP BY 1, 2)
    SELECT names.p_name, names.p_brand, COALESCE(ids.found_id, previous.found_id) AS found_id
    FROM names LEFT JOIN ids ON names.p_name = ids.p_name AND names.p_brand = ids.p_brand
    LEFT JOIN previous ON names.p_name = previous.p_name AND names.p_brand = previous.p_brand
    """
)
def carry_forward_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = ["p_name", "p_brand"]
    names = part.select(*key).distinct()
    ids = part.where("p_size <= 25").groupBy(*key).agg(F.min("p_partkey").alias("found_id"))
    previous = part.where("p_size > 20 AND p_size <= 40").groupBy(*key).agg(F.max("p_partkey").alias("found_id"))
    return fill_from_previous(names.join(ids, key, "left"), previous, key, "found_id")


@query(
    """
    SELECT 'kept' AS part, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL
    SELECT 'left_out', o_orderkey FROM orders WHERE NOT EXISTS (
        SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
    """
)
def key_set_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    keys = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    kept = keep_keys(orders, keys, "c_custkey").select(F.lit("kept").alias("part"), "o_orderkey")
    left_out = drop_keys(orders, keys, "c_custkey").select(F.lit("left_out").alias("part"), "o_orderkey")
    return kept.unionByName(left_out)
