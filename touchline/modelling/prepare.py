"""Feature preparation as pipeline stages that keep what they learned."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import columns_of
from touchline.operators.aggregates import most_frequent, quantiles

# Skewness beyond which a column is transformed; columns that are never features.
SKEW_THRESHOLD = 1.0
ID_COLUMNS = ["player_id", "game_week", "team_id"]
KEY = "fix_id"


class _Stage(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols: Sequence[str] | None = None, **values):
        super().__init__()
        given = {"inputCols": None if inputCols is None else list(inputCols), **values}
        self._set(**{k: v for k, v in given.items() if v is not None})


class ColumnDropper(_Stage, Transformer):
    """Drops the columns that are there."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getInputCols())


class ZeroFill(_Stage, Transformer):
    """Numbers with 0 for NULL, as doubles."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.getInputCols()})


class TextFillModel(_Stage, Model):
    values = Param(Params._dummy(), "values", "one text per column", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = self.getOrDefault("values")
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in zip(self.getInputCols(), values)})


class ModeFill(_Stage, Estimator):
    """The most frequent text in place of NULL."""

    def _fit(self, df: DataFrame) -> TextFillModel:
        found = [most_frequent(df, c).first() for c in self.getInputCols()]
        return TextFillModel(self.getInputCols(), values=["" if row is None else str(row[0]) for row in found])


def constant_fill(columns: Sequence[str], value: str = "missing") -> TextFillModel:
    return TextFillModel(columns, values=[value] * len(columns))


class NumberFillModel(_Stage, Model):
    values = Param(Params._dummy(), "values", "one number per column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = self.getOrDefault("values")
        return df.withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in zip(self.getInputCols(), values)}
        )


class MedianFill(_Stage, Estimator):
    """The exact median in place of NULL."""

    def _fit(self, df: DataFrame) -> NumberFillModel:
        columns = self.getInputCols()
        medians = {r["column"]: r["quantile"] for r in quantiles(df, columns, [0.5]).collect()}
        return NumberFillModel(columns, values=[medians.get(c, 0.0) for c in columns])


class StandardizerModel(_Stage, Model):
    means = Param(Params._dummy(), "means", "one mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "one scale per column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = zip(self.getInputCols(), self.getOrDefault("means"), self.getOrDefault("scales"))
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in learned})


class Standardizer(_Stage, Estimator):
    """Zero mean and unit population deviation; constant columns are only centred."""

    def _fit(self, df: DataFrame) -> StandardizerModel:
        columns = self.getInputCols()
        row = df.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
        means, scales = row[: len(columns)], row[len(columns) :]
        return StandardizerModel(
            columns,
            means=[0.0 if m is None else m for m in means],
            scales=[s if s else 1.0 for s in scales],
        )


def yeo_johnson(x: Column, power: Column) -> Column:
    above = F.when(F.abs(power) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / power)
    rest = F.lit(2.0) - power
    below = F.when(F.abs(rest) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(F.lit(1.0) - x, rest) - 1) / rest)
    return F.when(x >= 0, above).otherwise(below)


def _power_series(x: Column, power: float) -> list[Column]:
    """The transformed value and its first and second derivative by the power."""

    def of(u: Column, p: float, sign: float) -> list[Column]:
        a = F.log(u)
        if abs(p) < 1e-5:
            # Near zero the quotients lose their digits; the series does not.
            terms = [a + p * a**2 / 2, a**2 / 2 + p * a**3 / 3, a**3 / 3 + p * a**4 / 4]
        else:
            grown = F.exp(p * a)
            value = (grown - 1) / p
            slope = (grown * a - value) / p
            terms = [value, slope, (grown * a**2 - 2 * slope) / p]
        # Below zero the power counts down from two.
        return [terms[0] * sign, terms[1], terms[2] * sign]

    above, below = of(F.greatest(x, F.lit(0.0)) + 1, power, 1.0), of(1 - F.least(x, F.lit(0.0)), 2.0 - power, -1.0)
    return [F.when(x >= 0, up).otherwise(down) for up, down in zip(above, below)]


def fit_powers(df: DataFrame, columns: Sequence[str], passes: int = 60) -> dict[str, float]:
    """The power of greatest likelihood for each column, by Newton's steps on its slope.

    A pass is one aggregate over all columns: sums of the transformed values, of
    their derivatives by the power and of the products give the slope and the
    bend of the likelihood. Steps that leave the bracket of the peak, or follow a
    bend upwards, are replaced by halving it. A column that never varies keeps 0.
    """
    if not columns:
        return {}
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    first = doubles.agg(
        *[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.sum(F.signum(c) * F.log1p(F.abs(c))).alias("gain"), (F.min(c) < F.max(c)).alias("varies")).alias(c) for c in columns]
    ).first()
    power = dict.fromkeys(columns, 0.0)
    bracket = {c: [-math.inf, math.inf] for c in columns}
    open_ = [c for c in columns if first[c]["varies"]]
    for _ in range(passes):
        if not open_:
            break
        sums = []
        for c in open_:
            # Measured from the mean's image, sums of squares lose no digits.
            y, slope, bend = [v - w for v, w in zip(_power_series(F.col(c), power[c]), _power_series(F.lit(first[c]["mean"]), power[c]))]
            parts = {"y": y, "s": slope, "b": bend, "yy": y * y, "ys": y * slope, "ss": slope * slope, "yb": y * bend}
            sums.append(F.struct(*[F.avg(v).alias(k) for k, v in parts.items()]).alias(c))
        row = doubles.agg(*sums).first()
        following = []
        for c in open_:
            m, n, low, high = row[c], first[c]["n"], *bracket[c]
            spread = m["yy"] - m["y"] ** 2
            first_by, second_by = 2 * (m["ys"] - m["y"] * m["s"]), 2 * (m["ss"] - m["s"] ** 2 + m["yb"] - m["y"] * m["b"])
            if not 0 < spread < math.inf:
                continue
            rise = first[c]["gain"] / n - first_by / spread / 2
            curve = (first_by / spread) ** 2 / 2 - second_by / spread / 2
            low, high = (power[c], high) if rise > 0 else (low, power[c])
            bracket[c] = [low, high]
            moved = power[c] - rise / curve if curve < 0 else math.inf if rise > 0 else -math.inf
            # At most one beyond the ends known so far, and inside the bracket.
            moved = min(max(moved, power[c] - 1), power[c] + 1)
            if not low < moved < high:
                moved = (low + high) / 2
            if abs(moved - power[c]) > 1e-10:
                following.append(c)
            power[c] = moved
        open_ = following
    return power


class SkewNormalizerModel(_Stage, Model):
    choices = Param(Params._dummy(), "choices", "log, exp, yeo-johnson or none per column", TypeConverters.toListString)
    powers = Param(Params._dummy(), "powers", "one power per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean after the power", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "deviation after the power", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        changed = {}
        learned = zip(*[self.getOrDefault(p) for p in ("inputCols", "choices", "powers", "means", "scales")])
        for column, choice, power, mean, scale in learned:
            if choice == "log":
                changed[column] = F.log1p(column)
            elif choice == "exp":
                changed[column] = F.expm1(column)
            elif choice == "yeo-johnson":
                changed[column] = (yeo_johnson(F.col(column), F.lit(power)) - F.lit(mean)) / F.lit(scale)
        return df.withColumns(changed) if changed else df


class SkewNormalizer(_Stage, Estimator):
    """Transforms skewed columns: log1p, a fitted power, or expm1 for a long left tail.

    ``method`` forces one choice for all columns. Choices and powers are learned at
    fit and kept, so scoring data are treated as the training data were.
    """

    threshold = Param(Params._dummy(), "threshold", "least absolute skewness", TypeConverters.toFloat)
    method = Param(Params._dummy(), "method", "auto, log, exp or yeo-johnson", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, threshold: float | None = None, method: str | None = None):
        super().__init__(inputCols, threshold=threshold, method=method)
        self._setDefault(threshold=SKEW_THRESHOLD, method="auto")

    def choose(self, df: DataFrame) -> dict[str, str]:
        columns = self.getInputCols()
        if self.getOrDefault("method") != "auto":
            return dict.fromkeys(columns, self.getOrDefault("method"))
        row = df.agg(*[F.skewness(c) for c in columns], *[F.min(F.coalesce((F.col(c) > 0), F.lit(False))) for c in columns]).first()
        chosen = {}
        for column, skew, positive in zip(columns, row[: len(columns)], row[len(columns) :]):
            if skew is None or math.isnan(skew) or abs(skew) <= self.getOrDefault("threshold"):
                chosen[column] = "none"
            elif skew > 0:
                chosen[column] = "log" if positive else "yeo-johnson"
            else:
                chosen[column] = "exp"
        return chosen

    def _fit(self, df: DataFrame) -> SkewNormalizerModel:
        columns = self.getInputCols()
        chosen = self.choose(df)
        powered = [c for c in columns if chosen[c] == "yeo-johnson"]
        powers = fit_powers(df, powered)
        learned: dict[str, tuple[float, float]] = {}
        if powered:
            after = [yeo_johnson(F.col(c), F.lit(powers[c])) for c in powered]
            row = df.agg(*[F.avg(a) for a in after], *[F.stddev_pop(a) for a in after]).first()
            learned = {c: (row[i], row[i + len(powered)] or 1.0) for i, c in enumerate(powered)}
        return SkewNormalizerModel(
            columns,
            choices=[chosen[c] for c in columns],
            powers=[powers.get(c, 1.0) for c in columns],
            means=[learned.get(c, (0.0, 1.0))[0] for c in columns],
            scales=[learned.get(c, (0.0, 1.0))[1] for c in columns],
        )


def preprocessor(df: DataFrame, drop_categoricals: bool = True, labels: Sequence[str] = ()) -> Pipeline:
    """Stages from a feature matrix to ``features``; the ordering key stays beside it."""
    texts = [c for c in columns_of(df, "string") if c not in ID_COLUMNS]
    dropped = ID_COLUMNS + (texts if drop_categoricals else [])
    numbers = [c for c in columns_of(df, "number") if c not in {KEY, *dropped, *labels}]
    stages: list = [ColumnDropper(dropped)]
    if numbers:
        stages += [ZeroFill(numbers), SkewNormalizer(numbers), Standardizer(numbers)]
    inputs = list(numbers)
    if not drop_categoricals and texts:
        indexed, encoded = [f"{c}_index" for c in texts], [f"{c}_onehot" for c in texts]
        stages += [
            ModeFill(texts),
            StringIndexer(inputCols=texts, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
        inputs += encoded
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])
