"""Aggregations: tenures, value scores, column profiles, prediction metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import columns_of, safe_ratio
from touchline.operators.quantiles import quantiles
from touchline.operators.ranking import capped_top_k
from touchline.operators.sets import common_rows

# Squad size and most players per position, weights of the combined error.
SQUAD = 10
SQUAD_CAPS = {"DEF": 5, "MID": 5, "FWD": 3}
GOAL_WEIGHT = 0.7
METRIC_WEIGHT = 0.5


def max_where(df: DataFrame, condition: Column, column: str) -> Column:
    """Largest value among the rows that qualify, as a scalar for further filters."""
    return df.where(condition).agg(F.max(column)).scalar()


def tenures(df: DataFrame, keys: Sequence[str], date: str, last_date: Column) -> DataFrame:
    """First and last date per key; the end stays open where it is not before ``last_date``."""
    last = F.max(date)
    return df.groupBy(*keys).agg(
        F.min(date).alias("start_date"), F.when(last < last_date, last).alias("end_date")
    )


def grouped_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def value_scores(
    df: DataFrame, value: str, minutes: str, per_value: Mapping[str, str], per_90: Mapping[str, str]
) -> DataFrame:
    """Scores per price and per 90 minutes: ``{output: summed column}``.

    A missing or zero price gives NULL; zero minutes give 0.
    """
    rate = F.when(F.col(minutes) > 0, F.lit(90) / F.col(minutes)).otherwise(F.lit(0.0))
    return df.withColumns(
        {
            **{out: F.try_divide(F.col(c), F.col(value)) for out, c in per_value.items()},
            **{out: F.col(c) * rate for out, c in per_90.items()},
        }
    )


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_fraction) for number columns, counted in one pass."""
    columns = columns_of(df, "number") if columns is None else list(columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "null_fraction")


def columns_with_nulls(df: DataFrame, threshold: float) -> list[str]:
    """Number columns whose share of NULLs exceeds ``threshold``; one row per column is collected."""
    over = null_fractions(df).where(F.col("null_fraction") > threshold)
    found = {row["column"] for row in over.collect()}
    return [c for c in df.columns if c in found]


def column_skewness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, skewness) in the population form, NULLs skipped, one pass."""
    columns = columns_of(df, "number") if columns is None else list(columns)
    one = df.agg(*[F.skewness(c).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "skewness")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per number column."""
    columns = columns_of(df, "number") if columns is None else list(columns)
    measures = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    one = df.agg(
        *[
            F.struct(*[f(F.col(c).cast("double")).alias(m) for m, f in measures.items()]).alias(c)
            for c in columns
        ]
    )
    moments = one.unpivot([], list(columns), "column", "m").select(
        "column", *[F.col(f"m.{m}").alias(m) for m in measures]
    )
    quarters = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = quantiles(df, columns, list(quarters.values()))
    wide = found.groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("quantile"))).alias(name) for name, s in quarters.items()]
    )
    return moments.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", *quarters, "max"
    )


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest of equally frequent ones, as a one-row table."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counted.orderBy(F.desc("count"), F.asc(column)).limit(1).select(column)


def rmse(actual: Column, predicted: Column) -> Column:
    difference = actual.cast("double") - predicted.cast("double")
    return F.sqrt(F.avg(difference * difference))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual.cast("double") - predicted.cast("double")))


def regression_errors(df: DataFrame, outputs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """RMSE and MAE of each (actual, predicted) pair as ``output<i>_rmse`` and ``output<i>_mae``."""
    measures = []
    for i, (actual, predicted) in enumerate(outputs, start=1):
        measures += [
            rmse(F.col(actual), F.col(predicted)).alias(f"output{i}_rmse"),
            mae(F.col(actual), F.col(predicted)).alias(f"output{i}_mae"),
        ]
    return df.groupBy(*by).agg(*measures)


def combined_error(
    df: DataFrame,
    outputs: Sequence[tuple[str, str]],
    goal_weight: float = GOAL_WEIGHT,
    metric_weight: float = METRIC_WEIGHT,
    by: Sequence[str] = (),
) -> DataFrame:
    """The errors of two outputs and ``combined_metric``.

    Each error is taken as its share of both outputs' error, the shares are
    weighted by output and by measure. It tells balance, not size, so the plain
    errors stay beside it. Two errors of zero give NULL.
    """
    errors = regression_errors(df, outputs, by)

    def weighted(measure: str) -> Column:
        first, second = F.col(f"output1_{measure}"), F.col(f"output2_{measure}")
        return F.try_divide(goal_weight * first + (1 - goal_weight) * second, first + second)

    combined = metric_weight * weighted("rmse") + (1 - metric_weight) * weighted("mae")
    return errors.withColumn("combined_metric", combined)


def ranking_metrics(df: DataFrame, predicted: str = "predicted_rank", actual: str = "actual_rank", k: int = 10) -> DataFrame:
    """Hit rate, precision and recall at k; hit rate and precision share one formula."""
    chosen, wanted = F.col(predicted) <= k, F.col(actual) <= k
    hits = F.count_if(chosen & wanted)
    return df.agg(
        F.try_divide(hits, F.count_if(chosen)).alias("hit_rate"),
        F.try_divide(hits, F.count_if(chosen)).alias("precision_at_k"),
        F.try_divide(hits, F.count_if(wanted)).alias("recall_at_k"),
    )


def topk_overlap(
    df: DataFrame,
    name: str,
    by: Sequence[str],
    overall: bool = False,
    predicted: str = "predicted_rank",
    actual: str = "actual_rank",
    k: int = 10,
) -> DataFrame:
    """Share of the actual top-k names also predicted, as sets of names per group.

    With ``overall`` the groups' counts are added up first.
    """
    wanted = df.where(F.col(actual) <= k).select(*by, name).distinct()
    chosen = df.where(F.col(predicted) <= k).select(*by, name).distinct()
    both = common_rows(wanted, chosen)
    groups = [] if overall else list(by)
    counted = (
        wanted.withColumn("_hit", F.lit(0)).unionByName(both.withColumn("_hit", F.lit(1)))
        .groupBy(*groups)
        .agg(F.count_if(F.col("_hit") == 1).alias("hits"), F.count_if(F.col("_hit") == 0).alias("wanted"))
    )
    groups_without = df.select(*groups).distinct() if groups else None
    if groups_without is not None:
        counted = groups_without.join(counted, groups, "left")
    return counted.withColumn("accuracy", safe_ratio(F.col("hits"), F.col("wanted"))).select(*groups, "accuracy")


def weighted_accuracy(df: DataFrame, predicted: str = "predicted_rank", actual: str = "actual_rank", k: int = 10) -> DataFrame:
    """Share of the actual top-k's rank weights (k for the first, 1 for the last) that was predicted."""
    weight = F.lit(k + 1) - F.col(actual)
    total = F.sum(weight)
    correct = F.sum(F.when(F.col(predicted) <= k, weight).otherwise(0))
    return df.where(F.col(actual) <= k).agg(safe_ratio(correct, total).alias("weighted_accuracy"))


def selection_totals(
    df: DataFrame,
    period: Sequence[str],
    group: str,
    predicted: str,
    actual: str,
    tie: Sequence[Column],
    caps: Mapping[str, int] = SQUAD_CAPS,
    k: int = SQUAD,
) -> DataFrame:
    """Points of the squad chosen by prediction beside the best possible squad, per period."""
    by_prediction = [F.col(predicted).desc_nulls_last(), F.col(actual).desc_nulls_last(), *tie]
    by_points = [F.col(actual).desc_nulls_last(), *tie]
    chosen = capped_top_k(df, period, group, caps, k, by_prediction)
    best = capped_top_k(df, period, group, caps, k, by_points)
    sums = chosen.groupBy(*period).agg(
        F.sum(predicted).alias("sum_predicted_points"), F.sum(actual).alias("sum_actual_points")
    )
    possible = best.groupBy(*period).agg(F.sum(actual).alias("best_possible_points"))
    return sums.join(possible, list(period)).withColumns(
        {
            "pred_best_ratio": F.try_divide(F.col("sum_predicted_points"), F.col("best_possible_points")),
            "actual_best_ratio": F.try_divide(F.col("sum_actual_points"), F.col("best_possible_points")),
        }
    )
