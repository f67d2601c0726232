"""Splits, preparation, models and monitoring on monthly supplier features."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.modelling.families import Facts, base_families, ensemble_families, label_facts
from touchline.modelling.gram import block_moments, expanding, fold_scores
from touchline.modelling.lifecycle import drift_check, retrain, score_to_table, select_features
from touchline.modelling.outliers import drop_outliers
from touchline.modelling.prepare import (
    MedianFill,
    ModeFill,
    SkewNormalizer,
    Standardizer,
    ZeroFill,
    constant_fill,
    fit_powers,
    preprocessor,
)
from touchline.modelling.search import leaderboard, search
from touchline.modelling.trees import Growth, TreesRegressor
from touchline.modelling.validation import expanding_folds, holdout_last
from touchline.operators.aggregates import most_frequent, quantiles
from touchline.operators.ranking import dense_id
from touchline.operators.windows import Trailing, trailing
from touchline.queries.registry import exact, month_index, plain, query, table
from touchline.session import scratch_path, written


@query(
    """
    WITH months AS (SELECT *, CAST(YEAR(o_orderdate) * 12 + MONTH(o_orderdate) AS INTEGER) AS month FROM orders),
    keys AS (SELECT month, ROW_NUMBER() OVER (ORDER BY month) AS r, COUNT(*) OVER () AS n FROM (SELECT DISTINCT month FROM months))
    SELECT o_orderkey, months.month, CAST((r - 1) // GREATEST(1, n // 5) AS INTEGER) AS block FROM months JOIN keys ON months.month = keys.month
    """
)
def expanding_folds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", month_index("o_orderdate").alias("month"))
    return expanding_folds(orders, "month", 4).select("o_orderkey", "month", "block")


def _holdout_sql(last: str) -> str:
    return f"""
        WITH months AS (SELECT o_orderkey, CAST(YEAR(o_orderdate) * 12 + MONTH(o_orderdate) AS INTEGER) AS month FROM orders),
        n AS (SELECT COUNT(DISTINCT month) // 10 AS n FROM months),
        last AS ({last})
        SELECT o_orderkey, month, CASE WHEN month IN (SELECT month FROM last) THEN 'test' ELSE 'train' END AS part FROM months
    """


def _holdout(spark: SparkSession, sf_dir: str, compat: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", month_index("o_orderdate").alias("month"))
    train, test = holdout_last(orders, "month", compat=compat)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("o_orderkey", "month", "part")


@query(_holdout_sql("SELECT month FROM (SELECT month, ROW_NUMBER() OVER (ORDER BY month DESC) AS r FROM (SELECT DISTINCT month FROM months)) WHERE r <= (SELECT n FROM n)"))
def holdout_last_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holdout(spark, sf_dir, compat=False)


@query(_holdout_sql("SELECT month FROM (SELECT month, ROW_NUMBER() OVER (ORDER BY month DESC) AS r FROM months) WHERE r <= (SELECT n FROM n)"))
def holdout_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holdout(spark, sf_dir, compat=True)


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _z_sql(expression: str) -> str:
    return f"({expression} - (SELECT AVG({expression}) FROM lineitem)) / (SELECT STDDEV_POP({expression}) FROM lineitem)"


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           ROUND({_z_sql("ln(1 + l_quantity)")}, 4) AS l_quantity, ROUND({_z_sql("l_extendedprice / 1000")}, 4) AS l_extendedprice,
           ROUND(exp(l_discount) - 1, 6) AS l_discount
    FROM lineitem
    """
)
def skew_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forced log1p and expm1, then standard scores, learned once and applied to all rows."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_extendedprice", F.col("l_extendedprice") / 1000)
    for column, method in (("l_quantity", "log"), ("l_discount", "exp")):
        lines = SkewNormalizer([column], method=method).fit(lines).transform(lines)
    scaled = ["l_quantity", "l_extendedprice"]
    lines = Standardizer(scaled).fit(lines).transform(lines)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *[F.round(c, 4).alias(c) for c in scaled], F.round("l_discount", 6).alias("l_discount"),
    )


@query(
    """
    SELECT c AS "column", CASE WHEN abs(s) <= 0.05 THEN 'none' WHEN s > 0 AND m > 0 THEN 'log' WHEN s > 0 THEN 'yeo-johnson' ELSE 'exp' END AS choice
    FROM (
    """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, MIN({c}) AS m, AVG(POWER({c} - a, 3)) / POWER(AVG(POWER({c} - a, 2)), 1.5) AS s FROM lineitem, (SELECT AVG({c}) AS a FROM lineitem)"
        for c in LINE_COLUMNS
    )
    + ")"
)
def skew_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    chosen = SkewNormalizer(LINE_COLUMNS, threshold=0.05).choose(lines)
    return spark.createDataFrame(list(chosen.items()), "column string, choice string")


POWER_COLUMNS = ["l_quantity", "l_discount", "l_tax", "p_retailprice"]
# Columns are moved so that some have values on both sides of zero.
POWER_SCALE = {"l_quantity": 0.1, "l_discount": 20.0, "l_tax": 30.0, "p_retailprice": 0.002}
POWER_SHIFT = {"l_quantity": 0.0, "l_discount": 0.7, "l_tax": 1.5, "p_retailprice": 2.5}


def _powers_sql() -> str:
    """The best of a grid of powers, and of ever finer ones around it."""
    value = "CASE WHEN x < 0 THEN CASE WHEN abs(2 - p) < 1e-9 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - p) - 1) / (2 - p) END WHEN abs(p) < 1e-9 THEN ln(1 + x) ELSE (pow(1 + x, p) - 1) / p END"
    sources = {c: "part" if c.startswith("p_") else "lineitem" for c in POWER_COLUMNS}
    data = " UNION ALL ".join(f"SELECT '{c}' AS c, {POWER_SCALE[c]} * {c} - {POWER_SHIFT[c]} AS x, COUNT(*) AS n FROM {t} GROUP BY 2" for c, t in sources.items())
    steps = [f"data AS MATERIALIZED ({data})", "best0 AS (SELECT DISTINCT c, CAST(0 AS DOUBLE) AS p FROM data)"]
    for i, step in enumerate((0.2, 0.01, 0.0005, 0.000025)):
        steps.append(f"grid{i} AS (SELECT c, p + k * {step} AS p FROM best{i}, (SELECT UNNEST(RANGE(-30, 31)) AS k))")
        steps.append(
            f"best{i + 1} AS MATERIALIZED (SELECT c, arg_max(p, likelihood) AS p FROM (SELECT c, p, -SUM(n) / 2 * ln(SUM(n * y * y) / SUM(n) - pow(SUM(n * y) / SUM(n), 2)) "
            f"+ (p - 1) * SUM(n * sign(x) * ln(1 + abs(x))) AS likelihood FROM (SELECT *, {value} AS y FROM data JOIN grid{i} USING (c)) GROUP BY c, p) GROUP BY c)"
        )
    return f"WITH {', '.join(steps)} SELECT c AS \"column\", ROUND(p, 3) AS power FROM best4"


@query(_powers_sql())
def yeo_johnson_powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = {c: (F.col(c) * POWER_SCALE[c] - POWER_SHIFT[c]).alias(c) for c in POWER_COLUMNS}
    lines = table(spark, sf_dir, "lineitem").select(*[v for c, v in moved.items() if c.startswith("l_")])
    parts = table(spark, sf_dir, "part").select(moved["p_retailprice"])
    powers = fit_powers(lines, lines.columns) | fit_powers(parts, parts.columns)
    return spark.createDataFrame([(c, round(p, 3)) for c, p in powers.items()], "column string, power double")


LABELS_SQL = "SELECT d.doc_id, quality, toxic, lang, source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


@query(
    f"""
    WITH d AS ({LABELS_SQL}), m AS (SELECT MEDIAN(quality) AS q FROM d),
    top AS (SELECT lang FROM d WHERE lang <> 'de' GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1)
    SELECT doc_id, CAST(COALESCE(toxic, 0) AS DOUBLE) AS toxic, CAST(COALESCE(quality, m.q) AS DOUBLE) AS quality,
           COALESCE(NULLIF(d.lang, 'de'), top.lang) AS lang, COALESCE(NULLIF(source, 'src1'), 'missing') AS source
    FROM d, m, top
    """
)
def impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero, median, most frequent and constant in place of NULL."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif("lang", F.lit("de")).alias("lang"), F.nullif("source", F.lit("src1")).alias("source")
    )
    rows = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = ZeroFill(["toxic"]).transform(rows)
    rows = MedianFill(["quality"]).fit(rows).transform(rows)
    rows = ModeFill(["lang"]).fit(rows).transform(rows)
    return constant_fill(["source"]).transform(rows).select("doc_id", "toxic", "quality", "lang", "source")


@query("SELECT o_orderpriority AS value FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1")
def mode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_frequent(table(spark, sf_dir, "orders"), "o_orderpriority").withColumnRenamed("o_orderpriority", "value")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({q} AS DOUBLE) AS share, ROUND(QUANTILE_CONT({c}, {q}), 6) AS quantile FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice")
        for q in (0.125, 0.5, 0.875)
    )
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], [0.125, 0.5, 0.875])
    return found.withColumn("quantile", F.round("quantile", 6))


@query(
    """
    SELECT o_orderkey, CAST(o_orderpriority = first AS DOUBLE) AS is_most_frequent, 5 AS width
    FROM orders, (SELECT o_orderpriority AS first FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
    """
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot priorities through the whole preparation pipeline; the most frequent value comes first."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("fix_id"), "o_orderpriority")
    prepared = preprocessor(orders, drop_categoricals=False).fit(orders).transform(orders)
    values = vector_to_array("features")
    return prepared.select(
        F.col("fix_id").alias("o_orderkey"), F.get(values, F.lit(0)).alias("is_most_frequent"), F.size(values).alias("width")
    )


FEATURES = ["minutes", "assists", "price", "lines"]
LABELS = {"label_goals": "goals", "label_assists": "assists"}
# All draws and folds of the linear families.
LINEAR_BUDGET = {"n_iter": 10, "folds": 5}


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as players and months as fixtures: form before each month, and the month's own totals as labels."""
    lines = table(spark, sf_dir, "lineitem")
    months = lines.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("game_week")).agg(
        F.sum(exact("l_quantity")).alias("minutes"),
        F.sum(exact("l_tax")).alias("goals"),
        F.sum(exact("l_discount")).alias("assists"),
        F.sum(exact("l_extendedprice")).alias("price"),
        F.count(F.lit(1)).alias("lines"),
    )
    specs = [Trailing(c, f"rolling_{f}_{c}", n) for f, n in (("ub", None), ("bound_last3", 3)) for c in FEATURES]
    form = trailing(months, specs, ["player_id", "year"], ["game_week"]).where("rolling_ub_minutes >= 90")
    matrix = form.select(
        "player_id",
        (F.col("year") * 12 + F.col("game_week")).alias("fix_id"),
        "game_week",
        F.col("year").cast("string").alias("season"),
        *[plain(source).alias(label) for label, source in LABELS.items()],
        *[plain(s.name).alias(s.name) for s in specs],
    )
    # Preparation, splits and fits all read the matrix.
    return written(matrix, "matrix")


PRICE = {"l_extendedprice": "predicted"}
PENALTY = {"Linear Regression": {}, "Ridge": {"alpha": 50_000.0}, "Lasso": {"alpha": 900.0}, "Elastic Net": {"alpha": 90.0, "l1_ratio": 0.4}}


@query(
    """
    SELECT ROUND(REGR_SLOPE(l_extendedprice, l_quantity), 3) AS slope, ROUND(REGR_INTERCEPT(l_extendedprice, l_quantity), 1) AS intercept
    FROM lineitem
    """
)
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines)
    family = next(f for f in base_families(0) if f.name == "Linear Regression")
    model = family.pipeline({}, label_facts(rows, PRICE), PRICE).fit(rows).stages[0]
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 3), round(model.intercept, 1))], "slope double, intercept double"
    )


@query(
    """
    WITH sums AS (
        SELECT COUNT(*) AS n, COVAR_POP(l_extendedprice, l_quantity) AS sxy, VAR_POP(l_quantity) AS sxx,
               AVG(l_quantity) AS mx, AVG(l_extendedprice) AS my FROM lineitem
    ), slopes AS (
        SELECT 'Linear Regression' AS model, sxy / sxx AS w, mx, my FROM sums
        UNION ALL SELECT 'Ridge', sxy / (sxx + 50000.0 / n), mx, my FROM sums
        UNION ALL SELECT 'Lasso', SIGN(sxy) * GREATEST(ABS(sxy) - 900.0, 0) / sxx, mx, my FROM sums
        UNION ALL SELECT 'Elastic Net', SIGN(sxy) * GREATEST(ABS(sxy) - 36.0, 0) / (sxx + 54.0), mx, my FROM sums
    )
    SELECT model, ROUND(w, 2) AS slope, ROUND(my - w * mx, 0) AS intercept FROM slopes
    """
)
def linear_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four linear families on one feature, where their penalties have closed forms."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines).persist()
    facts = label_facts(rows, PRICE)
    found = []
    for family in base_families(0):
        model = family.pipeline(PENALTY[family.name], facts, PRICE).fit(rows).stages[0]
        found.append((family.name, round(float(model.coefficients[0]), 2), float(round(model.intercept))))
    rows.unpersist()
    return spark.createDataFrame(found, "model string, slope double, intercept double")


STUMP = {"max_depth": 1, "min_samples_split": 2, "min_samples_leaf": 1}
UNSAMPLED = {
    "Decision Tree 1": STUMP,
    "RandomForest_1": {**STUMP, "n_estimators": 2, "bootstrap": False},
    "GradientBoosting_1": {"max_depth": 1, "learning_rate": 0.1, "n_estimators": 1, "subsample": 1.0, "colsample_bytree": 1.0},
    "Bagging_DecisionTree_1": {
        "n_estimators": 2, "max_samples": 1.0, "max_features": 1.0, "bootstrap": False, "bootstrap_features": False,
    },
}


@query(
    """
    WITH per AS (SELECT l_quantity AS q, COUNT(*) AS n, SUM(l_extendedprice) AS s FROM lineitem GROUP BY 1),
    cuts AS (
        SELECT q, SUM(n) OVER (ORDER BY q) AS ln, SUM(s) OVER (ORDER BY q) AS ls, SUM(n) OVER () AS n, SUM(s) OVER () AS s FROM per
    ), best AS (
        SELECT q, ls / ln AS below, (s - ls) / (n - ln) AS above, s / n AS mean, ln, n - ln AS rn FROM cuts WHERE n > ln
        ORDER BY ls * ls / ln + (s - ls) * (s - ls) / (n - ln) DESC LIMIT 1
    )
    SELECT model, per.q AS l_quantity, ROUND(CASE WHEN per.q <= best.q THEN below ELSE above END, 2) AS predicted
    FROM per, best, (VALUES ('Decision Tree 1'), ('RandomForest_1')) AS m(model)
    UNION ALL SELECT 'GradientBoosting_1', per.q, ROUND(mean + 0.1 * CASE WHEN per.q <= best.q THEN ln * (below - mean) / (ln + 1)
        ELSE rn * (above - mean) / (rn + 1) END, 2) FROM per, best
    UNION ALL SELECT 'Bagging_DecisionTree_1', q, ROUND(s / n, 2) FROM per
    """
)
def tree_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every family of trees on one feature without sampling: the best cut, and the mean of every value."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines).persist()
    facts = label_facts(rows, PRICE)
    # Every family predicts for these few rows; found once, not once a family.
    values = written(rows.select("l_quantity", "features").dropDuplicates(["l_quantity"]), "values")
    parts = []
    for family in [*base_families(1), *ensemble_families(1)]:
        if family.name in UNSAMPLED:
            fitted = family.pipeline(UNSAMPLED[family.name], facts, PRICE).fit(rows).transform(values)
            parts.append(fitted.select(F.lit(family.name).alias("model"), "l_quantity", F.round("predicted", 2).alias("predicted")))
    return reduce(DataFrame.unionByName, parts)


CELL = ["l_quantity", "l_discount", "l_tax"]


def _trees_sql(growth: Growth) -> str:
    """Trees grown over the distinct values of three columns: per level, the best of all cuts of every node."""
    steps = [
        f"m0 AS (SELECT {', '.join(CELL)}, COUNT(*) AS n, SUM(l_extendedprice / 1000) AS s, "
        f"CAST({'(SELECT AVG(l_extendedprice / 1000) FROM lineitem)' if growth.from_mean else '0'} AS DOUBLE) AS m FROM lineitem GROUP BY ALL)"
    ]
    for r in range(growth.rounds):
        steps.append(f"r{r}d0 AS MATERIALIZED (SELECT *, 1 AS node, TRUE AS open FROM m{r})")
        for d in range(growth.depth):
            now, cut, best = f"r{r}d{d}", f"r{r}c{d}", f"r{r}b{d}"
            values = " UNION ALL ".join(
                f"SELECT node, {i} AS f, {c} AS v, SUM(n * m - s) AS g, CAST(SUM(n) AS DOUBLE) AS h FROM {now} WHERE open GROUP BY node, {c}"
                for i, c in enumerate(CELL)
            )
            steps.append(
                f"{cut} AS (SELECT node, f, v, SUM(g) OVER low AS gl, SUM(h) OVER low AS hl, SUM(g) OVER one AS g, SUM(h) OVER one AS h FROM ({values}) "
                "WINDOW low AS (PARTITION BY node, f ORDER BY v), one AS (PARTITION BY node, f))"
            )
            gain = f"gl * gl / (hl + {growth.penalty}) + (g - gl) * (g - gl) / (h - hl + {growth.penalty}) - g * g / (h + {growth.penalty})"
            least = f"hl >= {growth.least_leaf} AND h - hl >= {growth.least_leaf} AND h >= {growth.least_split}"
            steps.append(
                f"{best} AS MATERIALIZED (SELECT node, f, v FROM (SELECT *, {gain} AS gain FROM {cut} WHERE {least}) WHERE gain > 1e-7 "
                "QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)"
            )
            own = f"CASE f {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(CELL))} END"
            steps.append(
                f"r{r}d{d + 1} AS MATERIALIZED (SELECT x.* EXCLUDE (node, open), "
                f"CASE WHEN f IS NULL THEN x.node ELSE x.node * 2 + CAST({own} > v AS INTEGER) END AS node, f IS NOT NULL AS open "
                f"FROM {now} x LEFT JOIN {best} b ON x.node = b.node AND x.open)"
            )
        steps.append(
            f"m{r + 1} AS MATERIALIZED (SELECT * EXCLUDE (node, open, m), "
            f"m - {growth.rate} * SUM(n * m - s) OVER (PARTITION BY node) / (SUM(n) OVER (PARTITION BY node) + {growth.penalty}) AS m FROM r{r}d{growth.depth})"
        )
    return f"WITH {', '.join(steps)} SELECT {', '.join(CELL)}, ROUND(m, 4) AS predicted FROM m{growth.rounds}"


def _cells_predicted(spark: SparkSession, sf_dir: str, growth: Growth) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*CELL, (F.col("l_extendedprice") / 1000).alias("price"))
    rows = VectorAssembler(inputCols=CELL, outputCol="features").transform(lines)
    regressor = TreesRegressor(growth).setParams(featuresCol="features", labelCol="price", predictionCol="predicted")
    found = regressor.fit(rows).transform(rows.dropDuplicates(CELL))
    return found.select(*CELL, F.round("predicted", 4).alias("predicted"))


BOOSTED = Growth(rounds=3, depth=2, rate=0.3, penalty=1.0, from_mean=True)
DEEP = Growth(depth=4, least_leaf=40, least_split=200)


@query(_trees_sql(BOOSTED))
def boosted_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of second-order boosting, two levels deep, on three features."""
    return _cells_predicted(spark, sf_dir, BOOSTED)


@query(_trees_sql(DEEP))
def deep_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of four levels on three features, with least sizes of leaves and of splits."""
    return _cells_predicted(spark, sf_dir, DEEP)


@query(
    """
    SELECT name FROM (
        SELECT 'l_quantity' AS name, CORR(l_quantity, l_extendedprice) AS r FROM lineitem
        UNION ALL SELECT 'l_discount', CORR(l_discount, l_extendedprice) FROM lineitem
        UNION ALL SELECT 'l_tax', CORR(l_tax, l_extendedprice) FROM lineitem
        UNION ALL SELECT 'l_linenumber', CORR(l_linenumber, l_extendedprice) FROM lineitem)
    ORDER BY ABS(r) DESC LIMIT 2
    """
)
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(table(spark, sf_dir, "lineitem"))
    model = select_features(rows.select("features", "l_extendedprice"), "l_extendedprice", 2)
    return spark.createDataFrame([(names[i],) for i in model.selectedFeatures], "name string")


@query()
def outlier_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = feature_matrix(spark, sf_dir)
    prepared = preprocessor(matrix, labels=list(LABELS)).fit(matrix).transform(matrix)
    kept = drop_outliers(prepared.select("fix_id", *LABELS, "features"))
    return kept.groupBy("fix_id").agg(F.count(F.lit(1)).alias("kept"), F.round(F.avg("label_goals"), 4).alias("mean_goals"))


@query(
    """
    SELECT COUNT(*) AS planted, CAST(0 AS BIGINT) AS planted_kept, TRUE AS most_others_kept FROM customer WHERE c_custkey % 100 = 0
    """
)
def planted_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whom every hundredth is moved far away: all of those go, most others stay."""
    far = F.when(F.col("c_custkey") % 100 == 0, 50.0).otherwise(0.0)
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 1000 + far).alias("balance"),
        (F.col("c_nationkey").cast("double") - 4 * far).alias("nation"),
    )
    rows = VectorAssembler(inputCols=["balance", "nation"], outputCol="features").transform(customers)
    rows = rows.select("c_custkey", (F.col("c_custkey") % 100 == 0).alias("moved"), "features")
    counts = {r["moved"]: r["count"] for r in rows.groupBy("moved").count().collect()}
    kept = {r["moved"]: r["count"] for r in drop_outliers(rows).groupBy("moved").count().collect()}
    found = (counts.get(True, 0), kept.get(True, 0), kept.get(False, 0) > counts.get(False, 0) / 2)
    return spark.createDataFrame([found], "planted long, planted_kept int, most_others_kept boolean")


def _search_sql() -> str:
    """All draws of the linear families on one feature, where a fold's weights have a closed form."""
    draws = []
    for family in base_families(0):
        for i, params in enumerate(family.draw(10)):
            # Ridge's penalty is per row: its share of the mean is taken with a number of rows of one.
            absolute, quadratic = family.penalty(params, Facts(1))
            per_row, fixed = (quadratic, 0.0) if family.name == "Ridge" else (0.0, quadratic)
            draws.append(f"('{family.name}', {i}, {absolute!r}, {per_row!r}, {fixed!r})")
    slope = "sign(c{i}) * greatest(abs(c{i}) - absolute, 0) / (v + per_row / n + fixed)"
    return f"""
    WITH data AS (
        SELECT CAST(YEAR(l_shipdate) * 12 + MONTH(l_shipdate) AS INTEGER) AS month, l_quantity / 10 AS x,
               l_extendedprice / 10000 AS y1, l_tax * 20 AS y2 FROM lineitem
    ), keys AS (SELECT month, ROW_NUMBER() OVER (ORDER BY month) AS r, COUNT(*) OVER () AS n FROM (SELECT DISTINCT month FROM data)),
    dealt AS (SELECT data.*, (r - 1) // GREATEST(1, n // 6) AS block FROM data JOIN keys USING (month)),
    folds AS (SELECT UNNEST(RANGE(1, 6)) AS fold),
    sums AS (
        SELECT fold, COUNT(*) AS n, COVAR_POP(y1, x) AS c1, COVAR_POP(y2, x) AS c2, VAR_POP(x) AS v, AVG(x) AS mx, AVG(y1) AS m1, AVG(y2) AS m2
        FROM folds JOIN dealt ON block < fold GROUP BY fold
    ), draws(model, draw, absolute, per_row, fixed) AS (VALUES {", ".join(draws)}),
    lines AS (SELECT *, {slope.format(i=1)} AS w1, {slope.format(i=2)} AS w2 FROM sums, draws),
    errors AS (
        SELECT model, draw, fold, SQRT(AVG(POWER(y1 - m1 - w1 * (x - mx), 2))) AS r1, AVG(ABS(y1 - m1 - w1 * (x - mx))) AS a1,
               SQRT(AVG(POWER(y2 - m2 - w2 * (x - mx), 2))) AS r2, AVG(ABS(y2 - m2 - w2 * (x - mx))) AS a2
        FROM lines JOIN dealt ON block = fold GROUP BY model, draw, fold
    )
    SELECT model, draw, ROUND(AVG(0.5 * (0.7 * r1 + 0.3 * r2) / (r1 + r2) + 0.5 * (0.7 * a1 + 0.3 * a2) / (a1 + a2)), 6) AS combined,
           ROUND(AVG(r1), 6) AS goals_rmse, ROUND(AVG(a1), 6) AS goals_mae, ROUND(AVG(r2), 6) AS assists_rmse, ROUND(AVG(a2), 6) AS assists_mae
    FROM errors GROUP BY model, draw
    """


@query(_search_sql())
def linear_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole budget of the linear families, ten draws and five folds, on one feature."""
    lines = table(spark, sf_dir, "lineitem").select(
        month_index("l_shipdate").alias("month"),
        (F.col("l_quantity") / 10).alias("x"),
        (F.col("l_extendedprice") / 10_000).alias("label_goals"),
        (F.col("l_tax") * 20).alias("label_assists"),
    )
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(lines)
    seen: dict[str, int] = {}
    found = []
    for r in search(rows, base_families(0), "month"):
        draw = seen[r.family.name] = seen.get(r.family.name, -1) + 1
        means = [r.means[m] for m in ("combined_metric", "output1_rmse", "output1_mae", "output2_rmse", "output2_mae")]
        found.append((r.family.name, draw, *[round(v, 6) for v in means]))
    names = ", ".join(f"{c} double" for c in ("combined", "goals_rmse", "goals_mae", "assists_rmse", "assists_mae"))
    return spark.createDataFrame(found, f"model string, draw int, {names}")


@query(
    """
    WITH data AS (
        SELECT CAST(YEAR(l_shipdate) * 12 + MONTH(l_shipdate) AS INTEGER) AS month, l_quantity AS x0, l_discount * 100 AS x1, l_tax * 100 AS x2,
               l_extendedprice / 1000 AS y FROM lineitem
    ), keys AS (SELECT month, ROW_NUMBER() OVER (ORDER BY month) AS r, COUNT(*) OVER () AS n FROM (SELECT DISTINCT month FROM data)),
    dealt AS (SELECT data.*, (r - 1) // GREATEST(1, n // 6) AS block FROM data JOIN keys USING (month)),
    folds AS (SELECT UNNEST(RANGE(1, 6)) AS fold),
    trained AS (SELECT * FROM folds JOIN dealt ON block < fold)
    """
    + " UNION ALL ".join(
        f"SELECT fold, {i} AS i, {j} AS j, COUNT(*) AS n, ROUND(COVAR_POP({a}, {b}), 6) AS covariance FROM trained GROUP BY fold"
        for i, a in enumerate(("x0", "x1", "x2", "y"))
        for j, b in enumerate(("x0", "x1", "x2", "y"))
    )
)
def normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the linear draws of every fold are solved from."""
    lines = table(spark, sf_dir, "lineitem").select(
        month_index("l_shipdate").alias("month"), "l_quantity", (F.col("l_discount") * 100).alias("l_discount"),
        (F.col("l_tax") * 100).alias("l_tax"), (F.col("l_extendedprice") / 1000).alias("y"),
    )
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(lines)
    found = []
    for number, own in expanding(block_moments(expanding_folds(rows, "month", 5), ["y"]), 5).items():
        covariances = own.covariances
        found += [(number, i, j, own.rows, round(float(covariances[i, j]), 6)) for i in range(4) for j in range(4)]
    return spark.createDataFrame(found, "fold long, i int, j int, n long, covariance double")


@query(
    """
    WITH data AS (SELECT (l_quantity - 25) / 10 AS x, l_quantity * l_extendedprice / 1000000 AS y FROM lineitem),
    sums AS (
        SELECT COVAR_POP(x, x) AS a, COVAR_POP(x, x * x) AS b, COVAR_POP(x * x, x * x) AS d, COVAR_POP(x, y) AS u, COVAR_POP(x * x, y) AS v,
               AVG(x) AS mx, AVG(x * x) AS mxx, AVG(y) AS my FROM data
    ), w AS (SELECT *, (u * d - v * b) / (a * d - b * b) AS w1, (v * a - u * b) / (a * d - b * b) AS w2 FROM sums)
    SELECT x, ROUND(my + w1 * (x - mx) + w2 * (x * x - mxx), 5) AS predicted FROM w, (SELECT DISTINCT x FROM data)
    """
)
def squared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A family of degree two, almost without a penalty: least squares on a feature and its square."""
    x, y = ((F.col("l_quantity") - 25) / 10).alias("x"), (F.col("l_quantity") * F.col("l_extendedprice") / 1_000_000).alias("y")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(table(spark, sf_dir, "lineitem").select(x, y))
    ridge = next(f for f in base_families(0) if f.name == "Ridge")
    outputs = {"y": "predicted"}
    model = ridge.pipeline({"degree": 2, "alpha": 1e-9}, label_facts(rows, outputs), outputs).fit(rows)
    return model.transform(rows.dropDuplicates(["x"])).select("x", F.round("predicted", 5).alias("predicted"))


@query()
def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear families with the full budget: all their draws over five expanding folds."""
    matrix = feature_matrix(spark, sf_dir)
    prepared = preprocessor(matrix, labels=list(LABELS)).fit(matrix).transform(matrix)
    results = search(prepared.select("fix_id", *LABELS, "features"), base_families(0), "fix_id", **LINEAR_BUDGET)
    return leaderboard(spark, results)


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A model of the linear families with the full budget, saved."""
    matrix = feature_matrix(spark, sf_dir)
    path = scratch_path(spark, "model")
    retrain(matrix, path, families=(base_families(0),))
    return matrix, path


@query()
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, path = _trained(spark, sf_dir)
    return score_to_table(path, matrix, scratch_path(spark, "predictions"))


@query()
def drift_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix, path = _trained(spark, sf_dir)
    return drift_check(PipelineModel.load(path), matrix, "2000")


def _saved_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Line items as rows of players, and the saved model of both labels by least squares on the quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("player_id"),
        F.col("l_linenumber").alias("fix_id"),
        F.year("l_shipdate").cast("string").alias("season"),
        F.month("l_shipdate").alias("game_week"),
        "l_quantity",
        (F.col("l_extendedprice") / 1000).alias("label_goals"),
        (F.col("l_quantity") * F.col("l_discount")).alias("label_assists"),
    )
    family = next(f for f in base_families(0) if f.name == "Linear Regression")
    assembler = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    rows = assembler.transform(lines)
    path = scratch_path(spark, "model")
    PipelineModel([assembler, *family.pipeline({}, label_facts(rows)).fit(rows).stages]).save(path)
    return lines, path


LINES_SQL = """
    WITH data AS (
        SELECT l_orderkey, l_linenumber, YEAR(l_shipdate) AS season, MONTH(l_shipdate) AS week, l_quantity AS x,
               l_extendedprice / 1000 AS g, l_quantity * l_discount AS a FROM lineitem
    ), fit AS (
        SELECT REGR_SLOPE(g, x) AS wg, REGR_INTERCEPT(g, x) AS bg, REGR_SLOPE(a, x) AS wa, REGR_INTERCEPT(a, x) AS ba FROM data
    ), scored AS (SELECT data.*, bg + wg * x AS pg, ba + wa * x AS pa FROM data, fit)
"""


@query(
    LINES_SQL
    + """
    SELECT l_orderkey AS player_id, l_linenumber AS fixture_id,
           ROUND(pg, 5) AS predicted_goals, ROUND(pa, 5) AS predicted_assists FROM scored
    """
)
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two labels fitted, saved, loaded, scored and loaded into the prediction table."""
    lines, path = _saved_lines(spark, sf_dir)
    scored = score_to_table(path, lines, scratch_path(spark, "predictions"))
    rounded = [F.round(c, 5).alias(c) for c in ("predicted_goals", "predicted_assists")]
    return scored.select("player_id", "fixture_id", *rounded)


@query(
    LINES_SQL
    + """
    , latest AS (SELECT * FROM scored WHERE season = 1995 AND week = (SELECT MAX(week) FROM data WHERE season = 1995)),
    errors AS (
        SELECT SQRT(AVG(POWER(g - pg, 2))) AS r1, AVG(ABS(g - pg)) AS a1, SQRT(AVG(POWER(a - pa, 2))) AS r2, AVG(ABS(a - pa)) AS a2 FROM latest
    ), combined AS (SELECT *, 0.5 * (0.7 * r1 + 0.3 * r2) / (r1 + r2) + 0.5 * (0.7 * a1 + 0.3 * a2) / (a1 + a2) AS m FROM errors)
    SELECT ROUND(r1, 6) AS output1_rmse, ROUND(a1, 6) AS output1_mae, ROUND(r2, 6) AS output2_rmse, ROUND(a2, 6) AS output2_mae,
           ROUND(m, 6) AS combined_metric, t AS threshold, m > t AS retrain
    FROM combined, (VALUES (CAST(0.55 AS DOUBLE)), (CAST(0.65 AS DOUBLE))) AS thresholds(t)
    """
)
def saved_model_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the loaded model on a season's latest week, and whether it is to be trained anew, at two thresholds."""
    lines, path = _saved_lines(spark, sf_dir)
    model = PipelineModel.load(path)
    found = reduce(DataFrame.unionByName, [drift_check(model, lines, "1995", threshold) for threshold in (0.55, 0.65)])
    return found.select(*[F.round(c, 6).alias(c) if c not in ("threshold", "retrain") else c for c in found.columns])


VALIDATED = ("y0", "y1")


@query(
    """
    WITH data AS (
        SELECT CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 4 AS fold, l_quantity AS x,
               l_extendedprice / 1000 AS y0, l_quantity * l_discount + l_tax AS y1 FROM lineitem
    ), folds AS (SELECT UNNEST(RANGE(4)) AS f),
    fits AS (
        SELECT f, REGR_SLOPE(y0, x) AS w0, REGR_INTERCEPT(y0, x) AS b0, REGR_SLOPE(y1, x) AS w1, REGR_INTERCEPT(y1, x) AS b1
        FROM folds JOIN data ON fold <> f GROUP BY f
    )
    """
    + " UNION ALL ".join(
        f"""
        SELECT CAST(f AS INTEGER) AS fold, '{y}' AS label, COUNT(*) AS rows, ROUND(1 - AVG(POWER({y} - b{i} - w{i} * x, 2)) / VAR_POP({y}), 6) AS r2,
               ROUND(SQRT(AVG(POWER({y} - b{i} - w{i} * x, 2))), 6) AS rmse, ROUND(AVG(ABS({y} - b{i} - w{i} * x)), 6) AS mae
        FROM fits JOIN data ON fold = f GROUP BY f"""
        for i, y in enumerate(VALIDATED)
    )
)
def plain_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of least squares over folds by a hash of the key."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        (F.col("l_extendedprice") / 1000).alias("y0"),
        (F.col("l_quantity") * F.col("l_discount") + F.col("l_tax")).alias("y1"),
    )
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines)
    scores = fold_scores(rows, VALIDATED, "l_orderkey", 4)
    return scores.select("fold", "label", "rows", *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")])


@query(
    """
    SELECT ROW_NUMBER() OVER (ORDER BY month) AS key_rank, month
    FROM (SELECT DISTINCT CAST(YEAR(o_orderdate) * 12 + MONTH(o_orderdate) AS INTEGER) AS month FROM orders)
    """
)
def ordered_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "orders").select(month_index("o_orderdate").alias("month")).distinct()
    return dense_id(months, ["month"], "key_rank")
