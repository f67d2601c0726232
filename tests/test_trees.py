"""Trees on histograms against plain loops with the same draws, and on unseen rows."""

import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from touchline.modelling import trees as module
from touchline.modelling.families import base_families, ensemble_families, label_facts
from touchline.modelling.trees import Growth, TreesRegressor, bin_edges, uniform
from touchline.session import scratch_path

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 12, 500), rng.integers(0, 5, 500), rng.integers(0, 30, 500), rng.normal(size=500)]).astype(float)
    y = x[:, 0] * (x[:, 1] > 2) + np.sin(x[:, 2] / 4) * 3 + x[:, 3] + rng.normal(size=500) * 0.2
    rows = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).coalesce(3).cache()


def fitted(data, growth):
    return TreesRegressor(growth).setParams(featuresCol="features", labelCol="y", predictionCol="p").fit(data)


def plain_tree(rows, bins, gradient, weight, growth, number, width):
    """Node numbers do not matter for the values, only for the order in which a split tries features: they follow the growth by levels."""
    features = growth.features(number, width)
    tree = module.Tree()
    held = {0: np.flatnonzero(weight > 0)}

    def value(own):
        return -np.sum(weight[own] * gradient[own]) / (np.sum(weight[own]) + growth.penalty)

    tree.value[0] = value(held[0])
    level = [0]
    for _ in range(growth.depth):
        following = []
        for node in level:
            own = held[node]
            if len(own) < max(growth.least_split, 2):
                continue
            order, compete = growth.order(number, node, features)
            best = (1e-7, None)
            for i, f in enumerate(order):
                if i >= compete and best[1]:
                    break
                for cut in np.unique(bins[own, f])[:-1]:
                    left = bins[own, f] <= cut
                    if min(left.sum(), (~left).sum()) < growth.least_leaf:
                        continue
                    score = 0.0
                    for side, sign in ((own[left], 1), (own[~left], 1), (own, -1)):
                        score += sign * np.sum(weight[side] * gradient[side]) ** 2 / (np.sum(weight[side]) + growth.penalty)
                    if score > best[0] + 1e-9:
                        best = (score, (f, int(cut)))
            if best[1]:
                f, cut = best[1]
                goes = bins[own, f] <= cut
                child = tree.split(node, f, cut, (value(own[goes]), value(own[~goes])))
                held[child], held[child + 1] = own[goes], own[~goes]
                following += [c for c in (child, child + 1) if len(held[c]) >= max(growth.least_split, 2 * growth.least_leaf, 2)]
        level = following
    return tree


GROWTHS = {
    "tree": Growth(depth=4, least_leaf=5, least_split=40, per_split=0.5),
    "boosted": Growth(rounds=3, depth=2, rate=0.3, penalty=1.0, rows=0.6, columns=0.5, from_mean=True),
    "bagged": Growth(parallel=5, depth=1000, least_leaf=8, rows=0.5, rows_repeat=True, columns=0.75, columns_repeat=True),
    "drawn": Growth(parallel=3, depth=3, rows=0.3, columns=0.5),
    "forest": Growth(parallel=4, depth=5, least_leaf=3, least_split=12, rows_repeat=True, per_split=0.5),
}


@pytest.mark.parametrize("name", GROWTHS)
def test_agrees_with_a_plain_loop(spark, monkeypatch, data, name):
    growth = GROWTHS[name]
    if name in ("boosted", "forest"):
        # Small portions, few trees side by side, and margins written often.
        monkeypatch.setattr(module, "CELLS", 4 * 64 * 3)
        monkeypatch.setattr(module, "TREES_AT_ONCE", 3)
        monkeypatch.setattr(module, "ROUNDS_PER_TABLE", 2)
    model = fitted(data, growth)
    content = json.loads(model.getOrDefault("content"))
    numbered = data.select(F.monotonically_increasing_id().alias("row"), *FEATURES, "y").toPandas()
    bins = module.binned(numbered[FEATURES].to_numpy(), content["edges"])
    rows, y = numbered["row"].to_numpy(), numbered["y"].to_numpy()
    margin = np.full(len(y), content["base"])
    assert growth.from_mean == (content["base"] == pytest.approx(y.mean()))
    found = model.trees()
    assert len(found) == growth.rounds * growth.parallel
    for number, tree in enumerate(found):
        expected = plain_tree(rows, bins, margin - y, growth.weights(rows, number), growth, number, 4)
        assert (tree.feature, tree.cut, tree.left) == (expected.feature, expected.cut, expected.left)
        assert tree.value == pytest.approx(expected.value)
        if growth.rounds > 1:
            margin = margin + growth.rate * expected.predict(bins)
    predicted = model.transform(data).select("p").toPandas()["p"].to_numpy()
    plain = margin if growth.rounds > 1 else np.mean([t.predict(bins) for t in found], axis=0)
    assert predicted == pytest.approx(plain)


def test_boosting_learns_for_unseen_rows(spark, data):
    train, test = data.where("a % 3 <> 1"), data.where("a % 3 = 1")
    growth = Growth(rounds=25, depth=3, rate=0.3, penalty=1.0, from_mean=True)
    errors = []
    for rounds in (1, 25):
        scored = fitted(train, replace(growth, rounds=rounds)).transform(test)
        errors.append(scored.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2))).first()[0])
    assert errors[1] < 0.35 * errors[0]
    odd = spark.createDataFrame([(99.0, -5.0, float("nan"), 1e9)], "a double, b double, c double, d double")
    value = fitted(train, growth).transform(VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(odd)).first().p
    assert abs(value) < 50


def test_draws_have_their_shares():
    rows = np.arange(200_000)
    draw = uniform(rows, 42, 3)
    assert abs(draw.mean() - 0.5) < 0.005 and 0 <= draw.min() and draw.max() < 1
    assert abs(np.corrcoef(draw, uniform(rows, 42, 4))[0, 1]) < 0.01
    assert Growth(rows=0.3).weights(rows, 0).mean() == pytest.approx(0.3, abs=0.005)
    poisson = Growth(rows=0.8, rows_repeat=True).weights(rows, 1)
    assert poisson.mean() == pytest.approx(0.8, abs=0.01) and poisson.var() == pytest.approx(0.8, abs=0.02)
    assert len(Growth(columns=0.5).features(0, 40)) == 20
    assert len(Growth(columns=1.0, columns_repeat=True).features(0, 400)) == pytest.approx(400 * (1 - np.exp(-1)), abs=30)


def test_edges_are_all_values_of_few_and_quantiles_of_many(spark):
    rows = spark.createDataFrame([([float(i % 7), float(i), 3.0],) for i in range(4000)], "x array<double>").repartition(5)
    few, many, one = bin_edges(rows, "x", 16)
    assert few == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] and one == []
    assert len(many) == 15 and np.abs(np.array(many) - 250 * np.arange(1, 16)).max() < 60


def test_few_rows_null_labels_and_saving(spark, data):
    growth = Growth(rounds=2, depth=2, rate=0.5, penalty=1.0, from_mean=True)
    with_null = data.unionByName(data.limit(5).withColumn("y", F.lit(None).cast("double")))
    assert fitted(with_null, growth).transform(data).where("p is null").isEmpty()
    assert fitted(data.limit(0), growth).transform(data).where("p <> 0").isEmpty()
    one = data.limit(1).cache()
    assert fitted(one, growth).transform(data).select("p").distinct().collect()[0].p == pytest.approx(one.first().y)
    path = scratch_path(spark, "trees")
    regressor = TreesRegressor(growth).setParams(featuresCol="features", labelCol="y", predictionCol="p")
    model = Pipeline(stages=[regressor]).fit(data)
    model.save(path)
    loaded = PipelineModel.load(path)
    a, b = (m.transform(data).select("p").toPandas()["p"] for m in (model, loaded))
    assert np.array_equal(a, b)


def test_families_use_these_trees():
    for family in [*base_families(2), *ensemble_families(2)]:
        if family.penalty is None:
            growths = [json.loads(family.build(p, label_facts).getOrDefault("growth")) for p in family.draw(5)]
            assert len({json.dumps(g) for g in growths}) > 1


def test_bins_are_packed_and_read_without_an_object_per_row():
    from touchline.modelling.trees import _binary, _matrix

    bins = np.arange(60, dtype=np.uint8).reshape(20, 3)
    packed = _binary(bins)
    assert packed.to_pylist() == [b.tobytes() for b in bins]
    assert (_matrix(packed, 20, np.uint8) == bins).all()
    assert (_matrix(packed.slice(5, 7), 7, np.uint8) == bins[5:12]).all()
