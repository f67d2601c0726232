"""Ranks, prediction metrics, selections, value scores and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.aggregates import (
    SQUAD_CAPS,
    column_skewness,
    columns_with_nulls,
    combined_error,
    grouped_sums,
    max_where,
    null_fractions,
    numeric_summary,
    ranking_metrics,
    selection_totals,
    tenures,
    topk_overlap,
    value_scores,
    weighted_accuracy,
)
from touchline.operators.quality import check, overlapping
from touchline.operators.ranking import capped_top_k, first_n
from touchline.plans.reports import with_points, with_ranks
from touchline.queries.registry import exact, month_index, plain, query, table
from touchline.queries.relations import TENURE_SQL


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as players of a week: the type is the position, two numbers stand for goals."""
    day = F.dayofyear("ts")
    kind = F.col("event_type")
    position = F.when(kind == "click", "FWD").when(kind == "view", "MID").when(kind == "purchase", "DEF").otherwise("GK")
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("user "), "user_id").alias("player_name"),
        position.alias("position"),
        F.floor((day - 1) / 7).cast("int").alias("game_week"),
        F.lit("2024").alias("season"),
        (k % 7).alias("goals"),
        (k % 5).alias("assists"),
        (F.col("value") / 10 - 1).alias("predicted_goals"),
        (F.col("value") / 20 - 1).alias("predicted_assists"),
    )


SCORED_SQL = """
    SELECT event_id, 'user ' || user_id AS player_name,
           CASE event_type WHEN 'click' THEN 'FWD' WHEN 'view' THEN 'MID' WHEN 'purchase' THEN 'DEF' ELSE 'GK' END AS position,
           CAST((dayofyear(ts) - 1) // 7 AS INTEGER) AS game_week, '2024' AS season,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS goals, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS assists,
           value / 10 - 1 AS predicted_goals, value / 20 - 1 AS predicted_assists
    FROM events
"""
POINTS_SQL = f"""
    SELECT *, goals * weight + CASE WHEN weight IS NOT NULL THEN assists * 3 END AS points,
           GREATEST(predicted_goals, 0) * weight + CASE WHEN weight IS NOT NULL THEN GREATEST(predicted_assists, 0) * 3 END AS predicted_points
    FROM (SELECT *, CASE position WHEN 'FWD' THEN 4 WHEN 'MID' THEN 5 WHEN 'DEF' THEN 6 END AS weight FROM ({SCORED_SQL}))
"""
RANKED_SQL = f"""
    SELECT *, ROW_NUMBER() OVER (PARTITION BY position, game_week, season ORDER BY predicted_points DESC NULLS LAST, event_id) AS predicted_rank,
           ROW_NUMBER() OVER (PARTITION BY position, game_week, season ORDER BY points DESC NULLS LAST, event_id) AS actual_rank
    FROM ({POINTS_SQL})
"""


@query(f"SELECT event_id, position, points, ROUND(predicted_points, 6) AS predicted_points FROM ({POINTS_SQL})")
def points_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = with_points(scored_events(spark, sf_dir))
    return points.select("event_id", "position", "points", F.round("predicted_points", 6).alias("predicted_points"))


def ranked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ranks(with_points(scored_events(spark, sf_dir)), ["event_id"])


@query(
    f"""
    SELECT event_id, player_name, position, game_week, predicted_rank, actual_rank,
           CASE WHEN predicted_rank <= 10 AND actual_rank <= 10 THEN 'Correctly Predicted'
                WHEN predicted_rank <= 10 THEN 'False Positive' WHEN actual_rank <= 10 THEN 'Missed Prediction'
                ELSE 'Correctly Excluded' END AS prediction_accuracy
    FROM ({RANKED_SQL})
    """
)
def ranked_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_events(spark, sf_dir).select(
        "event_id", "player_name", "position", "game_week", "predicted_rank", "actual_rank", "prediction_accuracy"
    )


@query(
    f"""
    SELECT ROUND(hits / NULLIF(chosen, 0), 6) AS hit_rate, ROUND(hits / NULLIF(chosen, 0), 6) AS precision_at_k,
           ROUND(hits / NULLIF(wanted, 0), 6) AS recall_at_k
    FROM (SELECT CAST(COUNT(*) FILTER (predicted_rank <= 10 AND actual_rank <= 10) AS DOUBLE) AS hits,
          COUNT(*) FILTER (predicted_rank <= 10) AS chosen, COUNT(*) FILTER (actual_rank <= 10) AS wanted FROM ({RANKED_SQL}))
    """
)
def prediction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ranking_metrics(ranked_events(spark, sf_dir))
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def _overlap_sql(overall: bool) -> str:
    group = "" if overall else "position,"
    per = "" if overall else "GROUP BY position"
    return f"""
        WITH r AS ({RANKED_SQL}),
        wanted AS (SELECT DISTINCT position, player_name FROM r WHERE actual_rank <= 10),
        chosen AS (SELECT DISTINCT position, player_name FROM r WHERE predicted_rank <= 10),
        flagged AS (SELECT w.position, c.player_name IS NOT NULL AS hit FROM wanted w
                    LEFT JOIN chosen c ON c.position = w.position AND c.player_name = w.player_name)
        SELECT {group} ROUND(COUNT(*) FILTER (hit) / CAST(COUNT(*) AS DOUBLE), 6) AS accuracy FROM flagged {per}
    """


@query(_overlap_sql(False))
def topk_overlap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    overlap = topk_overlap(ranked_events(spark, sf_dir), "player_name", ["position"])
    return overlap.withColumn("accuracy", F.round("accuracy", 6))


@query(_overlap_sql(True))
def topk_overlap_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    overlap = topk_overlap(ranked_events(spark, sf_dir), "player_name", ["position"], overall=True)
    return overlap.withColumn("accuracy", F.round("accuracy", 6))


@query(
    f"""
    SELECT ROUND(SUM(CASE WHEN predicted_rank <= 10 THEN 11 - actual_rank ELSE 0 END) / CAST(SUM(11 - actual_rank) AS DOUBLE), 6) AS weighted_accuracy
    FROM ({RANKED_SQL}) WHERE actual_rank <= 10
    """
)
def weighted_accuracy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    accuracy = weighted_accuracy(ranked_events(spark, sf_dir))
    return accuracy.withColumn("weighted_accuracy", F.round("weighted_accuracy", 6))


def _errors_sql(by: str = "") -> str:
    errors = f"""
        SELECT {by + "," if by else ""} SQRT(AVG(POWER(l_tax - l_discount, 2))) AS r1, AVG(ABS(l_tax - l_discount)) AS m1,
               SQRT(AVG(POWER(l_quantity - l_linenumber, 2))) AS r2, AVG(ABS(l_quantity - l_linenumber)) AS m2
        FROM lineitem {"GROUP BY " + by if by else ""}
    """
    return f"""
        SELECT {by + "," if by else ""} ROUND(r1, 6) AS output1_rmse, ROUND(m1, 6) AS output1_mae, ROUND(r2, 6) AS output2_rmse, ROUND(m2, 6) AS output2_mae,
               ROUND(0.5 * (0.7 * r1 + 0.3 * r2) / (r1 + r2) + 0.5 * (0.7 * m1 + 0.3 * m2) / (m1 + m2), 6) AS combined_metric
        FROM ({errors})
    """


def _errors(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*by, "l_tax", "l_discount", "l_quantity", "l_linenumber")
    errors = combined_error(lines, [("l_tax", "l_discount"), ("l_quantity", "l_linenumber")], by=by)
    return errors.select(*by, *[F.round(c, 6).alias(c) for c in errors.columns if c not in by])


@query(_errors_sql())
def combined_error_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir, [])


@query(_errors_sql("l_suppkey"))
def combined_error_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir, ["l_suppkey"])


def _capped_sql(order: str, source: str) -> str:
    return f"""
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY season, game_week ORDER BY {order}) AS INTEGER) AS selection_rank FROM (
            SELECT * FROM ({source}) WHERE position IN ('DEF', 'MID', 'FWD')
            QUALIFY ROW_NUMBER() OVER (PARTITION BY season, game_week, position ORDER BY {order}) <= CASE position WHEN 'FWD' THEN 3 ELSE 5 END)
        QUALIFY selection_rank <= 10
    """


BY_PREDICTION = "predicted_points DESC NULLS LAST, points DESC NULLS LAST, event_id"


@query(f"SELECT season, game_week, position, event_id, selection_rank FROM ({_capped_sql(BY_PREDICTION, POINTS_SQL)})")
def capped_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc_nulls_last("predicted_points"), F.desc_nulls_last("points"), F.asc("event_id")]
    squad = capped_top_k(with_points(scored_events(spark, sf_dir)), ["season", "game_week"], "position", SQUAD_CAPS, 10, order)
    return squad.select("season", "game_week", "position", "event_id", "selection_rank")


@query(
    f"""
    WITH chosen AS (SELECT season, game_week, SUM(predicted_points) AS sp, SUM(points) AS sa FROM ({_capped_sql(BY_PREDICTION, POINTS_SQL)}) GROUP BY 1, 2),
    best AS (SELECT season, game_week, SUM(points) AS bp FROM ({_capped_sql("points DESC NULLS LAST, event_id", POINTS_SQL)}) GROUP BY 1, 2)
    SELECT season, game_week, ROUND(sp, 4) AS sum_predicted_points, CAST(sa AS BIGINT) AS sum_actual_points, CAST(bp AS BIGINT) AS best_possible_points,
           ROUND(sp / bp, 6) AS pred_best_ratio, ROUND(sa / bp, 6) AS actual_best_ratio
    FROM chosen JOIN best USING (season, game_week)
    """
)
def selection_vs_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = with_points(scored_events(spark, sf_dir))
    totals = selection_totals(points, ["season", "game_week"], "position", "predicted_points", "points", [F.asc("event_id")])
    return totals.withColumns(
        {
            "sum_predicted_points": F.round("sum_predicted_points", 4),
            "pred_best_ratio": F.round("pred_best_ratio", 6),
            "actual_best_ratio": F.round("actual_best_ratio", 6),
        }
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    best = first_n(orders, wanted, [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)
    return best.select("o_orderkey", "o_totalprice")


@query(
    """
    WITH sums AS (
        SELECT l_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS minutes,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS total_points, CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) AS egi
        FROM lineitem GROUP BY l_partkey)
    SELECT p_partkey, minutes, total_points, egi, p_retailprice AS value, ROUND(egi / p_retailprice, 6) AS egi_per_val,
           ROUND(total_points / p_retailprice, 6) AS p_per_val,
           ROUND(egi * CASE WHEN minutes > 0 THEN 90 / minutes ELSE 0 END, 6) AS egi_per_90,
           ROUND(total_points * CASE WHEN minutes > 0 THEN 90 / minutes ELSE 0 END, 6) AS p_per_90
    FROM sums JOIN part ON l_partkey = p_partkey
    """
)
def value_scores_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        exact("l_quantity").alias("minutes"),
        exact("l_extendedprice").alias("total_points"),
        exact("l_tax").alias("egi"),
    )
    sums = grouped_sums(lines, ["p_partkey"], ["minutes", "total_points", "egi"])
    sums = sums.select("p_partkey", *[plain(c).alias(c) for c in ("minutes", "total_points", "egi")])
    prices = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("value"))
    scores = value_scores(
        sums.join(prices, "p_partkey"), "value", "minutes",
        {"egi_per_val": "egi", "p_per_val": "total_points"}, {"egi_per_90": "egi", "p_per_90": "total_points"},
    )
    return scores.withColumns({c: F.round(c, 6) for c in ("egi_per_val", "p_per_val", "egi_per_90", "p_per_90")})


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED_SQL = "SELECT d.doc_id, n_chars, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


@query(
    f"""
    UNPIVOT (SELECT ROUND(AVG(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END), 6) AS doc_id, ROUND(AVG(CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END), 6) AS n_chars,
             ROUND(AVG(CASE WHEN quality IS NULL THEN 1 ELSE 0 END), 6) AS quality, ROUND(AVG(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END), 6) AS toxic
             FROM ({LABELLED_SQL}))
    ON doc_id, n_chars, quality, toxic INTO NAME "column" VALUE null_fraction
    """
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_fractions(_labelled(spark, sf_dir)).withColumn("null_fraction", F.round("null_fraction", 6))


@query(
    f"""
    SELECT doc_id, source, CASE WHEN share > 0.25 THEN NULL ELSE quality END AS quality
    FROM ({LABELLED_SQL}), (SELECT AVG(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS share FROM ({LABELLED_SQL}))
    """
)
def sparse_columns_blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir)
    sparse = columns_with_nulls(labelled, 0.25)
    quality = F.lit(None).cast("int") if "quality" in sparse else F.col("quality")
    return labelled.select("doc_id", "source", quality.alias("quality"))


SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS std, MIN({c}) AS min,
               ROUND(QUANTILE_CONT({c}, 0.25), 4) AS "25%", ROUND(QUANTILE_CONT({c}, 0.5), 4) AS "50%",
               ROUND(QUANTILE_CONT({c}, 0.75), 4) AS "75%", MAX({c}) AS max FROM lineitem
        """
        for c in SUMMARY_COLUMNS
    )
)
def numeric_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = numeric_summary(table(spark, sf_dir, "lineitem").select(*SUMMARY_COLUMNS))
    rounded = {c: F.round(F.col(f"`{c}`"), 4) for c in ("mean", "std", "25%", "50%", "75%")}
    return summary.withColumns(rounded)


def _skew_sql(column: str, source: str) -> str:
    return f"""
        SELECT '{column}' AS "column", ROUND(AVG(POWER(x - m, 3)) / POWER(AVG(POWER(x - m, 2)), 1.5), 4) AS skewness
        FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}), (SELECT AVG({column}) AS m FROM {source})
    """


@query(" UNION ALL ".join(_skew_sql(c, "lineitem") for c in SUMMARY_COLUMNS))
def skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*SUMMARY_COLUMNS)
    return column_skewness(lines).withColumn("skewness", F.round("skewness", 4))


@query(
    f"""
    SELECT 'required' AS "check", 'doc_id' AS "column", 0 AS failures
    UNION ALL SELECT 'required', 'absent', 1
    UNION ALL SELECT 'not_null', 'quality', COUNT(*) FILTER (quality IS NULL) FROM ({LABELLED_SQL})
    UNION ALL SELECT 'not_null', 'source', COUNT(*) FILTER (source IS NULL) FROM ({LABELLED_SQL})
    UNION ALL SELECT 'not_empty', '*', 0
    UNION ALL SELECT 'unique', 'doc_id', COUNT(*) FROM (SELECT doc_id FROM ({LABELLED_SQL}) GROUP BY 1 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'unique', 'source,n_chars', COUNT(*) FROM (SELECT source, n_chars FROM ({LABELLED_SQL}) GROUP BY 1, 2 HAVING COUNT(*) > 1)
    """
)
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(
        _labelled(spark, sf_dir),
        unique=["doc_id", ["source", "n_chars"]],
        not_null=["quality", "source"],
        required=["doc_id", "absent"],
        not_empty=True,
    )


@query(
    f"""
    WITH t AS ({TENURE_SQL})
    SELECT user_id, tenure FROM (
        SELECT *, MAX(COALESCE(end_date, TIMESTAMP '9999-12-31')) OVER (
            PARTITION BY user_id ORDER BY start_date, end_date NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM t)
    WHERE latest > start_date
    """
)
def tenure_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("tenure"), "ts")
    last_day = events.agg(F.max("ts").cast("date").cast("timestamp_ntz")).scalar()
    spans = tenures(events, ["user_id", "tenure"], "ts", last_day)
    return overlapping(spans, "user_id").select("user_id", "tenure")


@query(
    """
    SELECT o_custkey, CAST(YEAR(o_orderdate) * 12 + MONTH(o_orderdate) AS INTEGER) AS period, CAST(COUNT(*) AS BIGINT) AS orders
    FROM orders WHERE YEAR(o_orderdate) * 12 + MONTH(o_orderdate) = (
        SELECT MAX(YEAR(o_orderdate) * 12 + MONTH(o_orderdate)) FROM orders WHERE o_orderstatus = 'F')
    GROUP BY 1, 2
    """
)
def latest_finished_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", month_index("o_orderdate").alias("period"))
    last = max_where(orders, F.col("o_orderstatus") == "F", "period")
    return orders.where(F.col("period") == last).groupBy("o_custkey", "period").agg(F.count(F.lit(1)).alias("orders"))
