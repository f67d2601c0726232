"""Linear models from sums of products: one pass for all folds, then every draw is solved on a small matrix.

With rows dealt into consecutive blocks, the sums of a fold's training rows are
the sums of the blocks before it, added up. Least squares with a quadratic
penalty is a linear system in them, and one with an absolute penalty is solved on
them by coordinate descent; neither reads a row again. A second pass takes the
errors of all draws on the blocks they are tested on. What reaches the driver is
a matrix per block, whose size depends on the number of features alone.

Products are taken about the mean of all rows, so that large values lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = "block int, sums array<double>"
SWEEPS = 10_000
TOLERANCE = 1e-12


@dataclass(frozen=True)
class Moments:
    """Products of (1, features, labels) summed over rows, taken about ``shift``."""

    products: np.ndarray
    shift: np.ndarray
    labels: int

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.products + other.products, self.shift, self.labels)

    @property
    def rows(self) -> int:
        return round(self.products[0, 0])

    @property
    def means(self) -> np.ndarray:
        """Of features and labels, about the shift."""
        return self.products[0, 1:] / max(self.rows, 1)

    @property
    def covariances(self) -> np.ndarray:
        """Population covariances of features and labels."""
        return self.products[1:, 1:] / max(self.rows, 1) - np.outer(self.means, self.means)


@dataclass(frozen=True)
class Linear:
    """Weights (feature, label) and an intercept per label."""

    weights: np.ndarray
    intercepts: np.ndarray


def solve(moments: Moments, absolute: float = 0.0, quadratic: float = 0.0) -> Linear:
    """The least of half the mean squared error + absolute * |w| + quadratic / 2 * w ** 2; the intercept is free.

    Where features depend on each other and nothing is penalised, the shortest weights are taken.
    """
    d = len(moments.shift) - moments.labels
    covariances = moments.covariances
    among = covariances[:d, :d] + quadratic * np.eye(d)
    along = covariances[:d, d:]
    if absolute:
        weights = _descend(among, along, absolute)
    else:
        weights = np.linalg.pinv(among, rcond=1e-12, hermitian=True) @ along
    means = moments.means + moments.shift
    return Linear(weights, means[d:] - means[:d] @ weights)


def _descend(among: np.ndarray, along: np.ndarray, absolute: float) -> np.ndarray:
    """Coordinate descent with soft thresholds, one coordinate of all labels at a time."""
    weights = np.zeros_like(along)
    scale = np.sqrt(np.maximum(np.diag(among), 0))
    left = along.copy()
    for _ in range(SWEEPS):
        largest = 0.0
        for j in range(len(among)):
            if scale[j] == 0:
                continue
            pull = left[j] + among[j, j] * weights[j]
            moved = np.sign(pull) * np.maximum(np.abs(pull) - absolute, 0) / among[j, j]
            step = moved - weights[j]
            if step.any():
                left -= np.outer(among[:, j], step)
                weights[j] = moved
                largest = max(largest, float(np.abs(step).max()) * scale[j])
        if largest <= TOLERANCE * (1 + float(np.abs(weights * scale[:, None]).max(initial=0))):
            break
    return weights


def _matrices(batch: pa.RecordBatch, labels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, features and labels of a batch."""
    flat = batch.column(1).flatten().to_numpy()
    x = flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0))
    y = np.column_stack([batch.column(2 + i).to_numpy() for i in range(labels)])
    return batch.column(0).to_numpy(), x, y


def _rows(df: DataFrame, labels: Sequence[str], features: str) -> DataFrame:
    """Rows with both labels, as (block, features, labels)."""
    known = df.where(" AND ".join(f"`{label}` IS NOT NULL" for label in labels))
    numbers = [F.col(label).cast("double").alias(f"y{i}") for i, label in enumerate(labels)]
    return known.select(F.col("block").cast("int").alias("block"), vector_to_array(F.col(features)).alias("x"), *numbers)


def _added(partials: DataFrame) -> dict[int, np.ndarray]:
    """Sums of arrays per block, added in tasks; a row per block comes back."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = sums.values.to_numpy()
                total[block] = total[block] + values if block in total else values.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["block", "sums"]
        )

    return {r.block: np.array(r.sums) for r in partials.repartition("block").mapInArrow(add, SUMS).collect()}


def block_moments(df: DataFrame, labels: Sequence[str], features: str = "features") -> dict[int, Moments]:
    """Moments of every ``block`` of ``df``."""
    rows = _rows(df, labels, features)
    size = rows.select(F.size("x")).first()
    if size is None:
        return {}
    numbers = [*[F.get("x", F.lit(i)) for i in range(size[0])], *[F.col(f"y{i}") for i in range(len(labels))]]
    shift = np.array([v or 0.0 for v in rows.agg(*[F.avg(c) for c in numbers]).first()])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block, x, y = _matrices(batch, len(labels))
            whole = np.column_stack([np.ones(len(x)), np.column_stack([x, y]) - shift])
            for b in np.unique(block).tolist():
                own = whole[block == b]
                total[b] = total.get(b, 0) + own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.ravel() for t in total.values()], pa.list_(pa.float64()))],
            names=["block", "sums"],
        )

    found = _added(rows.mapInArrow(multiply, SUMS))
    side = len(shift) + 1
    return {block: Moments(sums.reshape(side, side), shift, len(labels)) for block, sums in found.items()}


def expanding(blocks: dict[int, Moments], folds: int) -> dict[int, Moments]:
    """The moments fold f is trained on: all blocks below f; folds without rows to train or test on are left out."""
    found, total = {}, None
    for number in range(1, folds + 1):
        before = blocks.get(number - 1)
        total = before if total is None else total + before if before else total
        if total is not None and number in blocks:
            found[number] = total
    return found


def fold_errors(
    df: DataFrame, models: dict[int, list[Linear]], labels: Sequence[str], features: str = "features"
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per fold, the root mean squared and the mean absolute error (model, label) of its models on the block of its number."""
    rows = _rows(df.where(F.col("block").isin(list(models))), labels, features)
    weights = {b: np.concatenate([m.weights for m in own], axis=1) for b, own in models.items()}
    intercepts = {b: np.concatenate([m.intercepts for m in own]) for b, own in models.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block, x, y = _matrices(batch, len(labels))
            for b in np.unique(block).tolist():
                own = block == b
                error = np.tile(y[own], len(models[b])) - (x[own] @ weights[b] + intercepts[b])
                sums = np.concatenate([[own.sum()], (error**2).sum(axis=0), np.abs(error).sum(axis=0)])
                total[b] = total.get(b, 0) + sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["block", "sums"]
        )

    found = {}
    for block, sums in _added(rows.mapInArrow(measure, SUMS)).items():
        squares, sizes = np.split(sums[1:] / sums[0], 2)
        found[block] = (np.sqrt(squares).reshape(-1, len(labels)), sizes.reshape(-1, len(labels)))
    return found


def hash_fold(key: str, folds: int) -> Column:
    """A fold from 0 for every key, by its hash, whatever rows there are."""
    digits = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % F.lit(folds)).cast("int")


def fold_scores(
    df: DataFrame, labels: Sequence[str], key: str, folds: int = 5, absolute: float = 0.0, quadratic: float = 0.0, features: str = "features"
) -> DataFrame:
    """(fold, label, rows, r2, rmse, mae) of linear models, each trained on all folds but the one it is tested on.

    The sums of the training rows are those of all rows less the fold's own, so the
    rows are read three times, however many folds there are.
    """
    dealt = df.withColumn("block", hash_fold(key, folds))
    moments = block_moments(dealt, labels, features)
    found = []
    if len(moments) > 1:
        models = {}
        for block in moments:
            others = [m for b, m in moments.items() if b != block]
            models[block] = [solve(sum(others[1:], others[0]), absolute, quadratic)]
        width = len(labels)
        for block, (rmse, mae) in sorted(fold_errors(dealt, models, labels, features).items()):
            spread = np.diag(moments[block].covariances)[-width:]
            for i, label in enumerate(labels):
                r2 = float(1 - rmse[0][i] ** 2 / spread[i]) if spread[i] > 0 else None
                found.append((block, label, moments[block].rows, r2, float(rmse[0][i]), float(mae[0][i])))
    return df.sparkSession.createDataFrame(found, "fold int, label string, rows long, r2 double, rmse double, mae double")
