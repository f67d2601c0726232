"""Preparation, outliers, splits, search and the model's life."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from touchline.modelling import prepare as p
from touchline.modelling.families import Facts, Family, base_families, ensemble_families, label_facts
from touchline.modelling.lifecycle import cross_validated, drift_check, predict, retrain, score_to_table, select_features
from touchline.modelling.outliers import IsolationForest, _grow, _path_correction, drop_outliers, fit_isolation_forest
from touchline.modelling.search import Result, best_per_family, leaderboard, n_best, search
from touchline.modelling.trees import TreesRegressor, uniform
from touchline.modelling.validation import expanding_folds, fold, holdout_last
from touchline.queries import models
from touchline.session import scratch_path, written


@pytest.fixture(scope="module")
def matrix(spark):
    """Twenty players over thirty fixtures; goals follow x, assists follow y."""
    rng = np.random.default_rng(3)
    rows = []
    for fixture in range(1, 31):
        for player in range(20):
            x, y = rng.normal(), rng.exponential()
            rows.append(
                (player, fixture, (fixture - 1) % 15 + 1, "2023-24" if fixture <= 15 else "2024-25", 90.0 + 10 * fixture,
                 float(x), None if rng.random() < 0.05 else float(y), float(2 * x + rng.normal() * 0.1), float(y + rng.normal() * 0.1))
            )
    columns = "player_id int, fix_id int, game_week int, season string, rolling_ub_minutes double, x double, y double, label_goals double, label_assists double"
    return spark.createDataFrame(rows, columns).cache()


def yeo_johnson(v, power):
    out = np.empty_like(v)
    up = v >= 0
    out[up] = np.log1p(v[up]) if abs(power) < 1e-12 else ((v[up] + 1) ** power - 1) / power
    out[~up] = -np.log1p(-v[~up]) if abs(2 - power) < 1e-12 else -((1 - v[~up]) ** (2 - power) - 1) / (2 - power)
    return out


def test_powers_reach_the_likelihoods_peak(spark):
    rng = np.random.default_rng(1)
    data = {"a": rng.lognormal(size=800), "b": rng.normal(size=800), "c": -rng.exponential(size=800)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in data.values()) for i in range(800)], "a double, b double, c double")
    fitted = p.fit_powers(df, list(data))
    for name, v in data.items():
        grid = np.arange(-4, 4, 0.002)
        likelihood = [-len(v) / 2 * np.log(yeo_johnson(v, g).var()) + (g - 1) * (np.sign(v) * np.log1p(abs(v))).sum() for g in grid]
        assert fitted[name] == pytest.approx(grid[int(np.argmax(likelihood))], abs=0.01)


def test_skew_choices_and_transforms(spark):
    rng = np.random.default_rng(2)
    tail = rng.exponential(size=400)
    rows = [(float(t + 1), float(t if i % 9 else 0), float(-t), float(rng.normal())) for i, t in enumerate(tail)]
    df = spark.createDataFrame(rows, "positive double, zeros double, negative double, even double")
    model = p.SkewNormalizer(df.columns).fit(df)
    assert model.getOrDefault("choices") == ["log", "yeo-johnson", "exp", "none"]
    out = model.transform(df)
    first, before = out.first(), df.first()
    assert first.positive == pytest.approx(np.log1p(before.positive)) and first.negative == pytest.approx(np.expm1(before.negative))
    assert first.even == before.even
    moments = out.agg(F.avg("zeros"), F.stddev_pop("zeros")).first()
    assert moments[0] == pytest.approx(0, abs=1e-9) and moments[1] == pytest.approx(1)
    half = model.transform(df.limit(10))
    assert half.first().zeros == pytest.approx(first.zeros), "learned at fit, not at transform"


def test_standardizer_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = p.Standardizer(["a", "b"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_fills(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 6.0), (None, None)], "t string, x double")
    assert p.ModeFill(["t"]).fit(df).transform(df).where("t = 'a'").count() == 3
    assert p.MedianFill(["x"]).fit(df).transform(df).agg(F.sum("x")).first()[0] == 11.0
    assert p.constant_fill(["t"]).transform(df).where("t = 'missing'").count() == 1
    assert p.ZeroFill(["x"]).transform(df).agg(F.min("x")).first()[0] == 0.0


def test_unknown_category_is_all_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "fix_id int, t string")
    model = p.preprocessor(df, drop_categoricals=False).fit(df)
    vectors = [r.features.toArray().tolist() for r in model.transform(spark.createDataFrame([(9, "b"), (9, "z")], "fix_id int, t string")).collect()]
    assert vectors == [[0.0, 1.0], [0.0, 0.0]]


def test_isolation_forest_finds_the_far_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, Vectors.dense(rng.normal(size=3))) for i in range(600)] + [(1000 + i, Vectors.dense([9.0 + i, -9.0, 9.0])) for i in range(3)]
    df = spark.createDataFrame(rows, ["id", "features"])
    forest = fit_isolation_forest(df)
    scores = {r.id: r.s for r in df.select("id", forest.score(F.col("features")).alias("s")).collect()}
    assert min(scores[1000 + i] for i in range(3)) > 0.6 > np.median(list(scores.values()))
    kept = drop_outliers(df)
    assert kept.where("id >= 1000").isEmpty() and kept.count() > 400


def test_the_forest_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(i, Vectors.dense(rng.normal(size=2))) for i in range(1500)] + [(5000, Vectors.dense([30.0, -30.0]))]
    df = spark.createDataFrame(rows, ["id", "features"])
    a, b = (fit_isolation_forest(df.repartition(n), trees=15) for n in (1, 8))
    assert all(np.array_equal(getattr(a, name), getattr(b, name)) for name in ("feature", "threshold", "left", "right", "length"))
    assert a.sample == 256 and drop_outliers(df.repartition(3), trees=15).where("id = 5000").isEmpty()
    few = df.limit(20)
    assert fit_isolation_forest(few, trees=4).sample == 20


def test_scores_follow_every_row_to_its_leaf():
    """Rows with NaN and infinities too, in trees of unequal depth; scores of a matrix need no session."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    x[0], x[1, 1], x[2, 0], x[3, 2] = np.nan, np.nan, np.inf, -np.inf
    grown = [_grow(rng.normal(size=(n, 3)), np.random.default_rng([1, n]), 5) for n in (1, 3, 32)]
    padded = np.zeros((6, 3, max(len(nodes) for nodes in grown)))
    padded[1], padded[3:5] = -1, -1
    depth = np.zeros(len(x))
    for t, nodes in enumerate(grown):
        for node in nodes:
            padded[:, t, node[0]] = node
        by_number = {n[0]: n[1:] for n in nodes}
        for i, row in enumerate(x):
            node = 0
            while by_number[node][0] >= 0:
                feature, threshold, left, right, _ = by_number[node]
                node = left if row[feature] <= threshold else right
            depth[i] += by_number[node][4]
    _, feature, threshold, left, right, length = padded
    forest = IsolationForest(feature.astype(int), threshold, left.astype(int), right.astype(int), length, 32)
    assert np.allclose(forest.scores(x), 2.0 ** (-depth / 3 / _path_correction(32)), rtol=1e-12)
    assert forest.scores(np.zeros((0, 3))).shape == (0,)


def test_monthly_totals_meet_their_windows_unwritten(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(models, "written", lambda df, name="table": tables.append(name) or written(df, name))
    models.feature_matrix(spark, "/root/testdata/sf0.001")
    assert tables == ["matrix"]


def test_a_whole_score_table_agrees_with_plain_numpy(spark):
    """Samples, trees and scores of all rows, computed anew from the draws alone."""
    rng = np.random.default_rng(9)
    rows = [(i, Vectors.dense(rng.normal(size=3).round(2))) for i in range(900)]
    df = spark.createDataFrame(rows, ["id", "features"]).repartition(6)
    forest = fit_isolation_forest(df, trees=7)
    scored = df.select("id", "features", F.xxhash64("id", vector_to_array("features")).alias("key"), forest.score(F.col("features")).alias("s")).collect()
    x = np.array([r.features.toArray() for r in scored])
    keys = np.array([r.key for r in scored])
    depth = np.zeros(len(x))
    for t in range(7):
        draw = uniform(keys, 42, t)
        sample = x[np.lexsort((keys, draw))[:256]]
        nodes = {n[0]: n[1:] for n in _grow(sample, np.random.default_rng([42, t]), 8)}
        for i, row in enumerate(x):
            node = 0
            while nodes[node][0] >= 0:
                feature, threshold, left, right, _ = nodes[node]
                node = left if row[feature] <= threshold else right
            depth[i] += nodes[node][4]
    expected = 2.0 ** (-depth / 7 / _path_correction(256))
    assert [r.s for r in scored] == pytest.approx(expected.tolist())
    plan = df.where(forest.score(F.col("features")) <= 0.5)._jdf.queryExecution().toString()
    assert "Generate" not in plan


def test_bagging_boosting_and_forests_are_fitted(spark, matrix):
    prepared = p.preprocessor(matrix, labels=["label_goals", "label_assists"]).fit(matrix).transform(matrix)
    for family in ensemble_families(1):
        params = {k: v for k, v in family.draw(1)[0].items()} | {"n_estimators": 4}
        params |= {"max_depth": 3} if "max_depth" in params else {}
        model = family.pipeline(params, label_facts(prepared)).fit(prepared)
        errors = model.transform(prepared).agg(F.stddev(F.col("predicted_goals") - F.col("label_goals")), F.stddev("label_goals")).first()
        assert errors[0] < errors[1]


def test_expanding_folds(spark):
    df = spark.createDataFrame([(k, i) for k in range(1, 12) for i in range(2)], "fix_id int, i int")
    blocks = expanding_folds(df, "fix_id", 4)
    for number in range(1, 5):
        train, test = fold(blocks, number)
        assert {r.fix_id for r in train.collect()} == set(range(1, 2 * number + 1))
        assert {r.fix_id for r in test.collect()} == {2 * number + 1, 2 * number + 2}
    with pytest.raises(ValueError):
        expanding_folds(df, "fix_id", 0)
    with pytest.raises(ValueError):
        expanding_folds(df.limit(0), "fix_id", 4)


def test_holdout_by_keys_and_by_rows(spark):
    df = spark.createDataFrame([(k, i) for k in range(1, 31) for i in range(5)], "fix_id int, i int")
    train, test = holdout_last(df, "fix_id")
    assert {r.fix_id for r in test.collect()} == {28, 29, 30} and train.count() == 135
    _, few = holdout_last(df, "fix_id", compat=True)
    assert {r.fix_id for r in few.collect()} == {30}


FITTED_AS = {
    "max_depth": "depth",
    "min_samples_leaf": "least_leaf",
    "min_samples_split": "least_split",
    "max_samples": "rows",
    "subsample": "rows",
    "learning_rate": "rate",
    "bootstrap": "rows_repeat",
    "max_features": "columns",
    "colsample_bytree": "columns",
    "bootstrap_features": "columns_repeat",
}


def test_parameter_draws_are_seeded_and_in_range():
    for family in base_families(2) + ensemble_families(2):
        assert family.draw(3) == family.draw(3)
        for params in family.draw(5):
            regressor = family.build({"degree": 1, **params}, Facts(100, 2.0))
            # What was drawn is what is fitted.
            if isinstance(regressor, TreesRegressor):
                growth = json.loads(regressor.getOrDefault("growth"))
                assert growth["rounds"] * growth["parallel"] == params.get("n_estimators", 1)
                assert all(growth[FITTED_AS[k]] == v for k, v in params.items() if k != "n_estimators")
    names = [f.name for f in base_families(2)]
    assert names == ["Linear Regression", "Ridge", "Lasso", "Elastic Net", "Decision Tree 1", "Decision Tree 2"]


def test_ranking_of_results(spark):
    families = {n: Family(n, None) for n in "abc"}
    results = [Result(families[n], {"i": i}, {m: v for m in ("combined_metric", "output1_rmse", "output1_mae", "output2_rmse", "output2_mae")}) for i, (n, v) in enumerate([("a", 0.5), ("a", 0.3), ("b", 0.4), ("c", float("nan"))])]
    board = leaderboard(spark, results).orderBy("overall_ranking").collect()
    assert [(r.model, r.params) for r in board] == [("a", '{"i": 1}'), ("b", '{"i": 2}'), ("a", '{"i": 0}'), ("c", '{"i": 3}')]
    assert len(best_per_family(results)) == 3 and [r.family.name for r in n_best(results, 2)] == ["a", "b"]
    with pytest.raises(ValueError):
        n_best(results, 4)


def small(families, names):
    return [f for f in families if f.name in names]


def test_search_keeps_all_metrics(spark, matrix):
    prepared = p.preprocessor(matrix, labels=["label_goals", "label_assists"]).fit(matrix).transform(matrix)
    families = small(base_families(1), ["Linear Regression", "Lasso"])
    results = search(prepared.select("fix_id", "label_goals", "label_assists", "features"), families, "fix_id", n_iter=1, folds=2)
    assert len(results) == 2
    linear = next(r for r in results if r.family.name == "Linear Regression")
    assert linear.means["output1_rmse"] < 0.3 and 0.3 <= linear.means["combined_metric"] <= 0.7


def test_train_keep_score_and_watch(spark, matrix):
    path, table = scratch_path(spark, "test-model"), scratch_path(spark, "test-scores")
    families = (small(base_families(1), ["Linear Regression", "Ridge"]),)
    trained = retrain(matrix, path, families=families, smoke=True, finalists=1, trees=10)
    assert trained.results.count() == 2 and trained.holdout_errors["output1_rmse"] < 0.3
    model = PipelineModel.load(path)
    a, b = ({(r.player_id, r.fixture_id): round(r.predicted_goals, 9) for r in predict(m, matrix).collect()} for m in (trained.model, model))
    assert a == b and len(a) == 600
    assert score_to_table(path, matrix, table).count() == 600
    row = drift_check(model, matrix, "2024-25", threshold=0.0).first()
    assert row.retrain is True and row.output1_rmse < 0.3
    assert drift_check(model, matrix, "2024-25", threshold=0.99).first().retrain is False
    assert drift_check(model, matrix, "1990-91").first().retrain is False


def test_selection_and_plain_validation(spark, matrix):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = VectorAssembler(inputCols=["rolling_ub_minutes", "x"], outputCol="features").transform(matrix)
    assert select_features(rows, "label_goals", 1).selectedFeatures == [1]
    validated = cross_validated(LinearRegression(labelCol="label_goals"), rows, "label_goals", folds=2)
    assert validated.avgMetrics[0] > 0.9
