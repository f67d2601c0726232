"""Selected places against sorted values: ties, wide ranges, values that are not finite, few bins."""

import numpy as np
import pytest

from touchline.operators.quantiles import quantiles, selected

SHARES = [0.0, 0.01, 0.25, 0.5, 0.777, 1.0]


@pytest.mark.parametrize("bins", [1024, 3])
def test_places_agree_with_sorting(spark, bins):
    rng = np.random.default_rng(bins)
    n = 700
    columns = {
        "even": rng.normal(size=n),
        "ties": rng.integers(0, 4, n).astype(float),
        "one": np.full(n, 7.25),
        "wide": np.where(rng.random(n) < 0.02, 1e300, 1.0) * rng.normal(size=n),
        "tiny": 1.0 + rng.integers(0, 9, n) * 2.0**-52,
        "ends": np.where(rng.random(n) < 0.1, np.inf, np.where(rng.random(n) < 0.1, -np.inf, rng.normal(size=n))),
    }
    rows = [tuple(float(v[i]) for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    every = {c: list(range(0, n, 37)) + [n - 1] for c in columns}
    found = selected(df, list(columns), every, bins)
    for c, values in columns.items():
        ordered = np.sort(values)
        assert all(found[c, k] == ordered[k] for k in every[c]), c
    got = {(r.column, r.share): r.quantile for r in quantiles(df.drop("ends"), [c for c in columns if c != "ends"], SHARES, bins).collect()}
    for (c, share), value in got.items():
        assert value == pytest.approx(np.quantile(columns[c], share), rel=1e-12)


def test_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([(1.0, None, None), (None, None, float("nan")), (3.0, None, 2.0), (2.0, None, float("nan"))], "a double, b double, c double")
    got = {(r.column, r.share): r.quantile for r in quantiles(df, ["a", "b", "c"], [0.0, 0.5]).collect()}
    assert got["a", 0.5] == 2.0 and ("b", 0.5) not in got and got["c", 0.0] == 2.0 and np.isnan(got["c", 0.5])
    assert quantiles(df.limit(0), ["a"], [0.5]).collect() == [] and quantiles(df, [], [0.5]).collect() == []
