"""Trailing windows, rates, sides and the next period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.columns import rate_per, safe_ratio, sum_of
from touchline.operators.aggregates import max_where
from touchline.operators.joins import unpivot_sides
from touchline.operators.windows import Trailing, carry_to_next_period, rolling_mean, trailing
from touchline.queries.registry import exact, plain, query, table
from touchline.session import written

FRAMES = {"ub": None, "last3": 3, "last6": 6}


def _event_sums(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", exact("value").alias("value"))
    specs = [Trailing("value", f"sum_{name}", rows, current) for name, rows in FRAMES.items()]
    rolled = trailing(events, specs, ["user_id"], ["ts", "event_id"], any_size=True)
    return rolled.select("event_id", "user_id", *[plain(s.name).alias(s.name) for s in specs])


def _event_sums_sql(end: str) -> str:
    frames = {"ub": "UNBOUNDED PRECEDING", "last3": "3 PRECEDING", "last6": "6 PRECEDING"}
    columns = ",\n".join(
        f"""CAST(SUM(CAST(value AS DECIMAL(18,4))) OVER (
            PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {start} AND {end}) AS DOUBLE) AS sum_{name}"""
        for name, start in frames.items()
    )
    return f"SELECT event_id, user_id, {columns} FROM events"


@query(_event_sums_sql("1 PRECEDING"))
def rolling_sum_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_sums(spark, sf_dir, current=False)


@query(_event_sums_sql("CURRENT ROW"))
def rolling_sum_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_sums(spark, sf_dir, current=True)


@query(
    """
    SELECT event_id, user_id, ROUND(AVG(value) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS value_avg_3
    FROM events
    """
)
def rolling_mean_min1(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    means = rolling_mean(events, ["value"], ["user_id"], ["ts", "event_id"], 3, "{}_avg_3", any_size=True)
    return means.select("event_id", "user_id", F.round("value_avg_3", 6).alias("value_avg_3"))


@query(
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id,
           SUM(CAST(value AS DECIMAL(18,4))) OVER prior AS sum_ub, COUNT(value) OVER prior AS n_ub,
           MIN(value) OVER prior AS min_ub, MAX(value) OVER prior AS max_ub,
           ROUND(AVG(value) OVER (PARTITION BY CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END
               ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 6) AS avg_last6
    FROM events
    WINDOW prior AS (PARTITION BY CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END
        ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """
)
def rolling_one_large_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All aggregates over a key that holds a third of the rows."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")).alias("user_id"),
        "ts",
        "value",
        exact("value").alias("amount"),
    )
    specs = [Trailing("amount", "sum_ub"), *[Trailing("value", f"{n}_ub", agg=a) for n, a in (("n", "count"), ("min", "min"), ("max", "max"))]]
    specs.append(Trailing("value", "avg_last6", 6, agg="avg"))
    rolled = trailing(events, specs, ["user_id"], ["ts", "event_id"], any_size=True)
    return rolled.select(
        "event_id", "user_id", "sum_ub", "n_ub", "min_ub", "max_ub", F.round("avg_last6", 6).alias("avg_last6")
    )


# Monthly supplier statistics stand in for a player's statistics per game week.
MONTHLY = {"minutes": "l_quantity", "goals": "l_tax", "expected_goals": "l_discount", "assists": "l_linenumber"}


def _supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        "l_suppkey", F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("game_week")
    ).agg(*[F.sum(exact(source)).alias(name) for name, source in MONTHLY.items()])


SUPPLIER_MONTHS_SQL = """
    SELECT l_suppkey, CAST(YEAR(l_shipdate) AS INTEGER) AS season, CAST(MONTH(l_shipdate) AS INTEGER) AS game_week,
           SUM(CAST(l_quantity AS DECIMAL(18,4))) AS minutes, SUM(CAST(l_tax AS DECIMAL(18,4))) AS goals,
           SUM(CAST(l_discount AS DECIMAL(18,4))) AS expected_goals, SUM(CAST(l_linenumber AS DECIMAL(18,4))) AS assists
    FROM lineitem GROUP BY 1, 2, 3
"""


def _rates_sql() -> str:
    frames = {"ub": "UNBOUNDED PRECEDING", "last3": "3 PRECEDING", "last6": "6 PRECEDING"}
    rolled = ",\n".join(
        f"CAST(SUM({c}) OVER (PARTITION BY l_suppkey, season ORDER BY game_week ROWS BETWEEN {start} AND 1 PRECEDING) AS DOUBLE) AS {c}_{f}"
        for f, start in frames.items()
        for c in MONTHLY
    )
    formulas = []
    for f in ("ub", "last3"):
        g, x, a, m = f"goals_{f}", f"expected_goals_{f}", f"assists_{f}", f"minutes_{f}"
        if f == "last3":
            formulas.append(f"ROUND(CASE WHEN COALESCE({x}, 0) > 0 THEN COALESCE({g}, 0) / {x} ELSE 0 END, 6) AS goals_efficiency_{f}")
        else:
            formulas.append(f"ROUND(CASE WHEN {x} > 0 THEN {g} / {x} ELSE 0 END, 6) AS goals_efficiency_{f}")
        formulas.append(f"ROUND(COALESCE({g}, 0) + COALESCE({a}, 0), 6) AS contribution_{f}")
        formulas.append(f"ROUND(CASE WHEN COALESCE({m}, 0) > 0 THEN COALESCE({g}, 0) / ({m} / 90) ELSE 0 END, 6) AS goals_per_90_{f}")
        formulas.append(f"ROUND(CASE WHEN COALESCE({m}, 0) > 0 THEN COALESCE({a}, 0) / ({m} / 90) ELSE 0 END, 6) AS assists_per_90_{f}")
    return f"""
        WITH months AS ({SUPPLIER_MONTHS_SQL}),
        rolled AS (SELECT l_suppkey, season, game_week, {rolled} FROM months)
        SELECT *, {", ".join(formulas)} FROM rolled
    """


@query(_rates_sql())
def rolling_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [Trailing(c, f"{c}_{frame}", rows) for frame, rows in FRAMES.items() for c in MONTHLY]
    rolled = trailing(_supplier_months(spark, sf_dir), specs, ["l_suppkey", "season"], ["game_week"])
    rolled = rolled.select("l_suppkey", "season", "game_week", *[plain(s.name).alias(s.name) for s in specs])
    formulas = {}
    for frame, coalesce in {"ub": False, "last3": True}.items():
        goals, assists, minutes = (F.col(f"{c}_{frame}") for c in ("goals", "assists", "minutes"))
        formulas |= {
            f"goals_efficiency_{frame}": safe_ratio(goals, F.col(f"expected_goals_{frame}"), coalesce),
            f"contribution_{frame}": sum_of(goals, assists),
            f"goals_per_90_{frame}": rate_per(goals, minutes),
            f"assists_per_90_{frame}": rate_per(assists, minutes),
        }
    return rolled.withColumns({name: F.round(value, 6) for name, value in formulas.items()})


def trade_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation against nation per month: customers' nation at home, suppliers' nation away."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("home_id"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("away_id"))
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.groupBy(
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("game_week"), "home_id", "away_id"
    ).agg(
        F.sum(exact("l_quantity")).alias("home_goals"),
        F.sum(exact("l_linenumber")).alias("away_goals"),
    )


TRADE_MATCHES_SQL = """
    SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS season, CAST(MONTH(o_orderdate) AS INTEGER) AS game_week,
           c_nationkey AS home_id, s_nationkey AS away_id,
           SUM(CAST(l_quantity AS DECIMAL(18,4))) AS home_goals, SUM(CAST(l_linenumber AS DECIMAL(18,4))) AS away_goals
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4
"""


def _two_sided_sql() -> str:
    frames = {"ub": "UNBOUNDED PRECEDING", "last3": "3 PRECEDING", "last6": "6 PRECEDING"}
    columns = ", ".join(
        f"""CAST(SUM(team_{c}) OVER (PARTITION BY team, season ORDER BY game_week, home_id, away_id, side
            ROWS BETWEEN {start} AND 1 PRECEDING) AS DOUBLE) AS {c}_{f}"""
        for f, start in frames.items()
        for c in ("scored", "conceded")
    )
    return f"""
        WITH matches AS ({TRADE_MATCHES_SQL}),
        sides AS (
            SELECT season, game_week, home_id, away_id, 'home' AS side, home_id AS team, home_goals AS team_scored, away_goals AS team_conceded FROM matches
            UNION ALL
            SELECT season, game_week, home_id, away_id, 'away' AS side, away_id AS team, away_goals AS team_scored, home_goals AS team_conceded FROM matches)
        SELECT season, game_week, home_id, away_id, side, team, {columns} FROM sides
    """


@query(_two_sided_sql())
def two_sided_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = unpivot_sides(
        trade_matches(spark, sf_dir),
        ["season", "game_week", "home_id", "away_id"],
        {
            "home": {"team": "home_id", "team_scored": "home_goals", "team_conceded": "away_goals"},
            "away": {"team": "away_id", "team_scored": "away_goals", "team_conceded": "home_goals"},
        },
    )
    specs = [Trailing(f"team_{c}", f"{c}_{f}", rows) for f, rows in FRAMES.items() for c in ("scored", "conceded")]
    rolled = trailing(sides, specs, ["team", "season"], ["game_week", "home_id", "away_id", "side"])
    return rolled.select(
        "season", "game_week", "home_id", "away_id", "side", "team", *[plain(s.name).alias(s.name) for s in specs]
    )


@query(
    f"""
    WITH months AS ({SUPPLIER_MONTHS_SQL}),
    last_done AS (
        SELECT MAX(MONTH(o_orderdate)) AS week FROM orders
        WHERE o_orderdate < TIMESTAMP '2000-07-01' AND YEAR(o_orderdate) = 2000),
    form AS (
        SELECT l_suppkey, season, game_week + 1 AS game_week,
               SUM(minutes) OVER w AS minutes_ub,
               SUM(minutes) OVER (PARTITION BY l_suppkey, season ORDER BY game_week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS minutes_last3,
               SUM(minutes) OVER (PARTITION BY l_suppkey, season ORDER BY game_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS minutes_last3_literal
        FROM months WHERE season = 2000
        WINDOW w AS (PARTITION BY l_suppkey, season ORDER BY game_week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    coming AS (
        SELECT DISTINCT l_orderkey, l_suppkey, CAST(MONTH(o_orderdate) AS INTEGER) AS game_week
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE YEAR(o_orderdate) = 2000 AND MONTH(o_orderdate) = (SELECT week + 1 FROM last_done))
    SELECT l_orderkey, form.l_suppkey, coming.game_week, CAST(minutes_ub AS DOUBLE) AS minutes_ub,
           CAST(minutes_last3 AS DOUBLE) AS minutes_last3, CAST(minutes_last3_literal AS DOUBLE) AS minutes_last3_literal
    FROM coming JOIN form ON form.l_suppkey = coming.l_suppkey AND form.game_week = coming.game_week
    """
)
def next_period_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 2000)
    orders = orders.select("o_orderkey", "o_orderdate", F.month("o_orderdate").alias("game_week"))
    finished = F.col("o_orderdate") < F.lit("2000-07-01").cast("timestamp")
    week = max_where(orders, finished, "game_week") + 1

    months = _supplier_months(spark, sf_dir).where(F.col("season") == 2000)
    specs = [
        Trailing("minutes", "minutes_ub", None, True),
        Trailing("minutes", "minutes_last3", 2, True),
        Trailing("minutes", "minutes_last3_literal", 3, True),
    ]
    form = carry_to_next_period(trailing(months, specs, ["l_suppkey", "season"], ["game_week"]), "game_week")

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    coming = (
        orders.where(F.col("game_week") == week)
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("l_orderkey", "l_suppkey", "game_week")
        .distinct()
    )
    joined = coming.join(form, ["l_suppkey", "game_week"])
    return joined.select(
        "l_orderkey", "l_suppkey", "game_week", *[plain(s.name).alias(s.name) for s in specs]
    )
