"""Train, keep, score and watch a two-output model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.modelling.families import OUTPUTS, SEED, Family, base_families, ensemble_families, label_facts
from touchline.modelling.outliers import TREES, drop_outliers
from touchline.modelling.prepare import KEY, preprocessor
from touchline.modelling.search import PAIRS, Result, choose, leaderboard, n_best, search
from touchline.modelling.validation import holdout_last
from touchline.operators.aggregates import combined_error, max_where
from touchline.session import cut_lineage
from touchline.sources.predictions import append_predictions

# Search budget, smoke budget, error above which a model is trained anew, minutes of a training row.
FULL_BUDGET = {"n_iter": 10, "variants": 5, "folds": 5}
SMOKE_BUDGET = {"n_iter": 1, "variants": 1, "folds": 2}
RETRAIN_ABOVE = 0.55
MIN_MINUTES = 90


@dataclass
class Trained:
    model: PipelineModel
    winner: Result
    holdout_errors: dict[str, float]
    results: DataFrame


def training_rows(matrix: DataFrame, min_minutes: int = MIN_MINUTES) -> DataFrame:
    return matrix.where(F.col("rolling_ub_minutes") >= min_minutes)


def train(
    matrix: DataFrame,
    families: tuple[list[Family], ...] | None = None,
    smoke: bool = False,
    finalists: int = 3,
    trees: int = TREES,
    seed: int = SEED,
) -> Trained:
    """From a labelled matrix to a fitted pipeline of preparation and regressors.

    Preparation learns from the training part alone, and outliers are left out of
    it only, so the hold-out stays whole and unseen; the final fit uses the same
    kept rows and the hold-out.
    """
    budget = SMOKE_BUDGET if smoke else FULL_BUDGET
    if families is None:
        families = (base_families(budget["variants"]), ensemble_families(budget["variants"]))
    labels = list(OUTPUTS)
    rest, last = holdout_last(matrix, KEY)
    prepare = preprocessor(rest, labels=labels).fit(rest)
    rest, holdout = (cut_lineage(prepare.transform(part).select(KEY, *labels, "features")) for part in (rest, last))
    kept = cut_lineage(drop_outliers(rest, seed=seed, trees=trees))

    results: list[Result] = []
    best: list[Result] = []
    for group in families:
        found = search(kept, group, KEY, budget["n_iter"], budget["folds"], seed)
        results += found
        best += n_best(found, min(finalists, len(group)))
    winner, _, errors = choose(best, kept, holdout)

    final_rows = kept.unionByName(holdout)
    regressors = winner.family.pipeline(winner.params, label_facts(final_rows)).fit(final_rows)
    model = PipelineModel(stages=[*prepare.stages, *regressors.stages])
    return Trained(model, winner, errors, leaderboard(matrix.sparkSession, results))


def retrain(matrix: DataFrame, path: str, **options) -> Trained:
    trained = train(training_rows(matrix), **options)
    trained.model.write().overwrite().save(path)
    return trained


def predict(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """(player_id, fixture_id, predicted_goals, predicted_assists); ids survive the preparation stages."""
    ids = F.struct("player_id", F.col(KEY).alias("fixture_id")).alias("_ids")
    scored = model.transform(matrix.withColumn("_ids", ids))
    return scored.select("_ids.*", *OUTPUTS.values())


def score_to_table(path: str, matrix: DataFrame, table: str, load: int = 0) -> DataFrame:
    """Predictions of a saved model appended to the table at ``table`` as one load, which may be repeated."""
    return append_predictions(predict(PipelineModel.load(path), matrix), table, load)


def drift_check(model: PipelineModel, matrix: DataFrame, season: str, threshold: float = RETRAIN_ABOVE) -> DataFrame:
    """One row: errors on the season's latest week and whether to train anew."""
    latest = max_where(matrix, F.col("season") == season, "game_week")
    rows = matrix.where((F.col("season") == season) & (F.col("game_week") == latest))
    errors = combined_error(model.transform(rows), PAIRS)
    return errors.withColumn("threshold", F.lit(float(threshold))).withColumn(
        "retrain", F.coalesce(F.col("combined_metric") > threshold, F.lit(False))
    )


def select_features(df: DataFrame, label: str, k: int = 30, features: str = "features"):
    """The ``k`` features of highest F value against the label, fitted."""
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol="selected", selectionMode="numTopFeatures"
    )
    selector = selector.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(k)
    return selector.fit(df)


def random_split(df: DataFrame, train_share: float = 0.6, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    train_rows, test_rows = df.randomSplit([train_share, 1 - train_share], seed)
    return train_rows, test_rows


def cross_validated(regressor, df: DataFrame, label: str, folds: int = 5, metric: str = "r2", seed: int = SEED) -> CrossValidatorModel:
    """Plain k-fold score of one regressor."""
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=regressor.getPredictionCol(), metricName=metric)
    validator = CrossValidator(
        estimator=regressor,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=evaluator,
        numFolds=folds,
        seed=seed,
    )
    return validator.fit(df)
