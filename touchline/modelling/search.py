"""Parameter search over expanding folds, leaderboard, and the choice of a model."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import DataFrame, SparkSession

from touchline.modelling.families import OUTPUTS, SEED, Facts, Family, label_facts
from touchline.modelling.gram import block_moments, expanding, fold_errors, solve
from touchline.modelling.validation import expanding_folds, fold
from touchline.operators.aggregates import GOAL_WEIGHT, METRIC_WEIGHT, combined_error

METRICS = ["combined_metric", "output1_rmse", "output1_mae", "output2_rmse", "output2_mae"]
PAIRS = list(OUTPUTS.items())


@dataclass
class Result:
    """Mean fold errors of one parameter draw."""

    family: Family
    params: dict
    means: dict[str, float] = field(default_factory=dict)


def score(model: PipelineModel, df: DataFrame) -> dict[str, float]:
    """All errors of a model on labelled rows, in one pass."""
    row = combined_error(model.transform(df), PAIRS).first()
    return {m: row[m] for m in METRICS}


def _mean(values: Sequence[float | None]) -> float:
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else float("nan")


def _combined(first: float, second: float) -> float | None:
    """The weighted share of two errors of one measure; NULL if both are zero."""
    return (GOAL_WEIGHT * first + (1 - GOAL_WEIGHT) * second) / (first + second) if first + second else None


def _metrics(rmse: Sequence[float], mae: Sequence[float]) -> dict[str, float | None]:
    rmse, mae = [float(v) for v in rmse], [float(v) for v in mae]
    shares = [_combined(*rmse), _combined(*mae)]
    known = None not in shares
    return {
        "combined_metric": METRIC_WEIGHT * shares[0] + (1 - METRIC_WEIGHT) * shares[1] if known else None,
        **{f"output{i}_rmse": v for i, v in enumerate(rmse, start=1)},
        **{f"output{i}_mae": v for i, v in enumerate(mae, start=1)},
    }


def linear_search(blocks: DataFrame, planned: Sequence[Result], folds: int) -> None:
    """Mean fold errors of all draws of linear families: two passes over the rows for all of them."""
    labels = list(OUTPUTS)
    for degree in sorted({r.params.get("degree", 1) for r in planned}):
        own = [r for r in planned if r.params.get("degree", 1) == degree]
        rows, column = blocks, "features"
        if degree > 1:
            column = "features_expanded"
            rows = PolynomialExpansion(degree=degree, inputCol="features", outputCol=column).transform(blocks)
        trained = expanding(block_moments(rows, labels, column), folds)
        models = {
            number: [solve(moments, *r.family.penalty(r.params, Facts(moments.rows))) for r in own]
            for number, moments in trained.items()
        }
        errors = fold_errors(rows, models, labels, column) if models else {}
        for i, result in enumerate(own):
            scores = [_metrics(rmse[i], mae[i]) for rmse, mae in errors.values()]
            result.means = {m: _mean([s[m] for s in scores]) for m in METRICS}


def search(
    df: DataFrame,
    families: Sequence[Family],
    key: str,
    n_iter: int = 10,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 2,
) -> list[Result]:
    """Errors of every family's draws over expanding folds; all metrics are kept.

    ``df`` has ``features``, both labels and the ordering key. Linear families are
    solved from sums of products, together; others are fitted by Spark, draw by
    draw and fold by fold, ``parallelism`` of them at a time.
    """
    blocks = expanding_folds(df, key, folds).persist()
    planned = [Result(family, params) for family in families for params in family.draw(n_iter, seed)]
    linear = [r for r in planned if r.family.penalty]
    if linear:
        linear_search(blocks, linear, folds)
    fitted = [r for r in planned if not r.family.penalty]
    sides = []
    for number in range(1, folds + 1) if fitted else ():
        train, test = fold(blocks, number)
        facts = label_facts(train)
        if all(f.rows for f in facts.values()) and not test.isEmpty():
            sides.append((train, test, facts))

    def run(result: Result) -> None:
        scores = [
            score(result.family.pipeline(result.params, facts).fit(train), test) for train, test, facts in sides
        ]
        result.means = {m: _mean([s[m] for s in scores]) for m in METRICS}

    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(run, fitted))
    blocks.unpersist()
    return planned


def _order(value: float) -> tuple[bool, float]:
    return (value != value, value)


def leaderboard(spark: SparkSession, results: Sequence[Result], metric: str = "combined_metric") -> DataFrame:
    """One row per draw with its mean errors and its rank over all families."""
    ordered = sorted(results, key=lambda r: _order(r.means[metric]))
    rows = [
        (rank, r.family.name, json.dumps(r.params, sort_keys=True), *[r.means[m] for m in METRICS])
        for rank, r in enumerate(ordered, start=1)
    ]
    columns = ", ".join(f"mean_{m} double" for m in METRICS)
    return spark.createDataFrame(rows, f"overall_ranking int, model string, params string, {columns}")


def best_per_family(results: Sequence[Result], metric: str = "combined_metric") -> list[Result]:
    best: dict[str, Result] = {}
    for r in results:
        name = r.family.name
        if name not in best or _order(r.means[metric]) < _order(best[name].means[metric]):
            best[name] = r
    return list(best.values())


def n_best(results: Sequence[Result], n: int = 3, metric: str = "combined_metric") -> list[Result]:
    """The best draw of the ``n`` best families."""
    families = best_per_family(results, metric)
    if n > len(families):
        raise ValueError(f"n must not exceed the number of models ({len(families)})")
    return sorted(families, key=lambda r: _order(r.means[metric]))[:n]


def choose(
    finalists: Sequence[Result], train: DataFrame, holdout: DataFrame, metric: str = "combined_metric"
) -> tuple[Result, PipelineModel, dict[str, float]]:
    """Refit the finalists on all training rows and keep the one with the least hold-out error."""
    facts = label_facts(train)
    best = None
    for result in finalists:
        model = result.family.pipeline(result.params, facts).fit(train)
        errors = score(model, holdout)
        if best is None or _order(_number(errors[metric])) < _order(_number(best[2][metric])):
            best = (result, model, errors)
    return best


def _number(value: float | None) -> float:
    return float("nan") if value is None else value
