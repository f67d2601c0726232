"""Linear draws solved from sums of products against Spark's own fits and plain numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from touchline.modelling.families import OUTPUTS, Facts, base_families, label_facts
from touchline.modelling.gram import block_moments, expanding, fold_errors, solve
from touchline.modelling.search import METRICS, search
from touchline.modelling.validation import expanding_folds, fold

LABELS = list(OUTPUTS)


@pytest.fixture(scope="module")
def rows(spark):
    """Correlated features off zero, one that never varies, and two labels."""
    rng = np.random.default_rng(4)
    made = []
    for i in range(900):
        x = rng.normal(size=3)
        features = [10 + x[0], x[0] + 0.5 * x[1], 2 * x[2] - 4, 7.0]
        made.append((i % 45, Vectors.dense(features), float(2 * x[0] - x[1] + rng.normal()), float(x[2] + 0.1 * rng.normal() + 3)))
    return spark.createDataFrame(made, ["fix_id", "features", *LABELS]).cache()


def test_draws_agree_with_sparks_fits(spark, rows):
    blocks = expanding_folds(rows, "fix_id", 3)
    moments = expanding(block_moments(blocks, LABELS), 3)
    assert list(moments) == [1, 2, 3]
    for number, own in moments.items():
        train, _ = fold(blocks, number)
        facts = label_facts(train)
        assert own.rows == train.count()
        for family in base_families(0):
            for params in family.draw(2):
                found = solve(own, *family.penalty(params, Facts(own.rows)))
                for i, model in enumerate(family.pipeline(params, facts).fit(train).stages):
                    assert found.weights[:3, i] == pytest.approx(model.coefficients.toArray()[:3], abs=5e-3)
                    assert abs(found.weights[3, i]) < 1e-9
                    at = np.array([10.0, 0.0, -4.0, 7.0])
                    assert found.intercepts[i] + at @ found.weights[:, i] == pytest.approx(model.predict(Vectors.dense(at)), abs=1e-2)


def test_solutions_are_least(spark, rows):
    """The slope of the error about the solution balances the penalties, for values far from zero too."""
    far = rows.select(F.lit(0).alias("block"), *LABELS, F.udf(lambda v: Vectors.dense([1e5 + v[0], v[1], v[2], v[3]]), VectorUDT())("features").alias("features"))
    moments = block_moments(far, LABELS)[0]
    data = far.toPandas()
    x, y = np.array([v.toArray() for v in data.features]), data[LABELS].to_numpy()
    for absolute, quadratic in [(0.0, 0.0), (0.0, 0.3), (0.2, 0.0), (0.15, 0.4), (1e6, 0.0)]:
        found = solve(moments, absolute, quadratic)
        left = y - x @ found.weights - found.intercepts
        assert np.abs(left.mean(axis=0)).max() < 1e-6
        slope = (x - x.mean(axis=0)).T @ left / len(x) - quadratic * found.weights
        held = found.weights != 0
        assert np.abs(slope - absolute * np.sign(found.weights))[held].max(initial=0) < 1e-6
        assert np.abs(slope[~held]).max(initial=0) <= absolute + 1e-6
        assert held.any() == (absolute < 1e6)


def test_search_agrees_with_fits_draw_by_draw(spark, rows):
    families = base_families(0)
    solved = search(rows, families, "fix_id", n_iter=2, folds=2)
    fitted = search(rows, [replace(f, penalty=None) for f in families], "fix_id", n_iter=2, folds=2)
    assert [(a.family.name, a.params) for a in solved] == [(b.family.name, b.params) for b in fitted]
    for a, b in zip(solved, fitted):
        assert [a.means[m] for m in METRICS] == pytest.approx([b.means[m] for m in METRICS], rel=2e-3)


def test_full_budget_takes_all_draws(spark, rows):
    results = search(rows, base_families(0), "fix_id")
    assert len(results) == 31 and all(r.means["output1_rmse"] > 0 for r in results)


def test_sums_do_not_depend_on_partitions_and_skip_unlabelled_rows(spark, rows):
    blocks = expanding_folds(rows, "fix_id", 4)
    unlabelled = blocks.limit(20).withColumn(LABELS[0], F.lit(None).cast("double"))
    a = block_moments(blocks.repartition(1), LABELS)
    b = block_moments(blocks.unionByName(unlabelled).repartition(7), LABELS)
    assert set(a) == set(b) == set(range(5))
    for block in a:
        assert a[block].rows == b[block].rows and np.allclose(a[block].covariances, b[block].covariances)
    assert block_moments(blocks.where("block > 99"), LABELS) == {}


def test_folds_without_rows_are_left_out(spark, rows):
    blocks = expanding_folds(rows, "fix_id", 3).where("block not in (0, 2)")
    trained = expanding(block_moments(blocks, LABELS), 3)
    assert list(trained) == [3]
    errors = fold_errors(blocks, {3: [solve(trained[3]), solve(trained[3], 1e9)]}, LABELS)
    rmse, mae = errors[3]
    test = blocks.where("block = 3").toPandas()
    train = blocks.where("block = 1").toPandas()
    for i, label in enumerate(LABELS):
        # A penalty that leaves no weight predicts the mean.
        error = test[label] - train[label].mean()
        assert rmse[1][i] == pytest.approx(np.sqrt((error**2).mean())) and mae[1][i] == pytest.approx(error.abs().mean())
        assert rmse[0][i] < rmse[1][i]


def test_degree_two_expands_features(spark, rows):
    ridge = next(f for f in base_families(0) if f.name == "Ridge")
    squared = replace(ridge, ranges={**ridge.ranges, "degree": lambda rng: 2})
    small = rows.select("fix_id", *LABELS, F.col("features")).where("fix_id < 30")
    solved = search(small, [squared], "fix_id", n_iter=1, folds=2)[0]
    fitted = search(small, [replace(squared, penalty=None)], "fix_id", n_iter=1, folds=2)[0]
    assert solved.params["degree"] == 2 and solved.means["output2_mae"] == pytest.approx(fitted.means["output2_mae"], rel=0.05)
