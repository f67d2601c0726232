"""Regression trees, bagged, boosted and random, grown level by level on shared histograms.

Every feature is cut into at most ``bins`` bins once. To grow a level, one
aggregate sums, per (node, feature, bin), the gradients, the hessians and the
number of rows: each task adds up its own rows, the sums of a node meet in one
task, and what comes back is a split per node. For squared errors the gradient is
prediction minus label and the hessian the row's weight; a leaf's value is
-G / (H + penalty), which without a penalty is the mean of its labels. Trees of a
forest grow side by side in the same pass.

A row's weight in a tree and a tree's features are drawn by hashes, so every pass
and every retried task sees the same draws: weights with repeats follow a Poisson
distribution, those without are 0 or 1. Nodes of a level are worked in portions
of bounded histograms, so memory depends neither on rows nor on the depth.

Rows with a NULL label are left out; without rows the model predicts 0.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import written

BINS = 64
# Cells of one portion's histograms, and trees of a forest that grow side by side.
CELLS = 1 << 20
TREES_AT_ONCE = 16
# Boosting rounds after which predictions are written instead of added up again.
ROUNDS_PER_TABLE = 16
LEAST_GAIN = 1e-7

BINNED = "row long, bins binary, y double, margin double"
EDGES = "feature int, values array<double>, many boolean"
SUMS = "slot int, cells array<int>, sums array<double>"
SPLITS = "slot int, feature int, cut int, gain double, left array<double>, whole array<double>"


@dataclass(frozen=True)
class Growth:
    """How trees grow: ``rounds`` correct each other by ``rate``, ``parallel`` trees of a round are averaged."""

    rounds: int = 1
    parallel: int = 1
    depth: int = 6
    rate: float = 1.0
    penalty: float = 0.0
    least_leaf: int = 1
    least_split: int = 2
    # Share of rows and features of a tree, drawn with repeats or without, and features tried per split.
    rows: float = 1.0
    rows_repeat: bool = False
    columns: float = 1.0
    columns_repeat: bool = False
    per_split: float | None = None
    # Boosting starts from the mean of the labels, other trees from nothing.
    from_mean: bool = False
    bins: int = BINS
    seed: int = 42

    def features(self, tree: int, width: int) -> list[int]:
        """The features of a tree; those drawn more than once count once."""
        n = max(1, int(self.columns * width))
        rng = random.Random(f"{self.seed}:columns:{tree}")
        drawn = rng.choices(range(width), k=n) if self.columns_repeat else rng.sample(range(width), n)
        return sorted(set(drawn))

    def order(self, tree: int, node: int, features: Sequence[int]) -> tuple[list[int], int]:
        """The order in which a split tries features, and how many of them compete; later ones step in if none of those can."""
        if self.per_split is None:
            return list(features), len(features)
        rng = random.Random(f"{self.seed}:split:{tree}:{node}")
        return rng.sample(list(features), len(features)), max(1, int(len(features) ** self.per_split))

    def weights(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """The weight of every row in a tree."""
        if self.rows >= 1 and not self.rows_repeat:
            return np.ones(len(rows))
        draw = uniform(rows, self.seed, tree)
        if not self.rows_repeat:
            return (draw < self.rows).astype(float)
        count, term = np.zeros(len(rows)), float(np.exp(-self.rows))
        through, k = term, 0
        while k < 40:
            count += draw >= through
            k += 1
            term *= self.rows / k
            through += term
        return count


def uniform(rows: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """Numbers in [0, 1) hashed from row and tree, by splitmix64."""
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree + 1) * 0xD1342543DE82EF95 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


@dataclass
class Tree:
    """Nodes by number; a node without a feature is a leaf, or open while the tree grows."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> int:
        """Gives a node two children; returns the left one, the right one follows it."""
        child = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, child
        self.feature += [-1, -1]
        self.cut += [0, 0]
        self.left += [0, 0]
        self.value += values
        return child

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node every row ends in."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            at = node[moving]
            node[moving] = left[at] + (bins[moving, feature[at]] > cut[at])
            moving = moving[feature[node[moving]] >= 0]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(bins)]


def binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bins of feature values: the number of edges below each."""
    columns = [np.searchsorted(np.array(e), values[:, i], "left") for i, e in enumerate(edges)]
    return np.column_stack(columns).astype(np.uint8) if columns else np.zeros((len(values), 0), np.uint8)


def _matrix(column: pa.Array, rows: int, kind: type) -> np.ndarray:
    if kind is np.uint8:
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + rows + 1]
        return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].reshape(rows, -1)
    return column.flatten().to_numpy().reshape(rows, -1)


def _binary(bins: np.ndarray) -> pa.Array:
    """Rows of bins as a binary column, without an object per row."""
    offsets = (np.arange(len(bins) + 1) * bins.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def bin_edges(df: DataFrame, array: str, bins: int = BINS) -> list[list[float]]:
    """Upper edges of all bins but the last: every value of a feature with few, else quantiles."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), batch.num_rows, float)
                found = found or [np.zeros(0)] * x.shape[1]
                # More than the bins can hold need not be known exactly.
                found = [np.unique(np.r_[f, np.unique(x[:, i])])[: bins + 1] for i, f in enumerate(found)]
        columns = [pa.array(range(len(found)), pa.int32()), pa.array(found, pa.list_(pa.float64())), pa.array([len(f) > bins for f in found])]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "values", "many"])

    parts = df.select(array).mapInArrow(few, EDGES)
    merged = parts.groupBy("feature").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("values")))).alias("values"), F.max("many").alias("many")
    )
    edges: dict[int, list[float]] = {}
    large = []
    # One row per feature, with at most bins + 1 values unless there are many.
    for row in merged.select("feature", F.slice("values", 1, bins + 1).alias("values"), "many").collect():
        if row.many or len(row["values"]) > bins:
            large.append(row.feature)
        else:
            edges[row.feature] = row["values"][:-1]
    if large:
        wide = df.select(*[F.get(array, F.lit(i)).alias(f"f{i}") for i in large])
        cuts = wide.approxQuantile(wide.columns, [i / bins for i in range(1, bins)], 0.1 / bins)
        edges |= {i: sorted(set(c)) for i, c in zip(large, cuts)}
    return [edges[i] for i in sorted(edges)]


def _bin_rows(batches: Iterator[pa.RecordBatch], edges: list[list[float]], base: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bins = binned(_matrix(batch.column(1), batch.num_rows, float), edges)
            columns = [batch.column(0), _binary(bins), batch.column(2), pa.array(np.full(len(bins), base))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "bins", "y", "margin"])


def _moved(batches: Iterator[pa.RecordBatch], trees: list[Tree], rate: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bins = _matrix(batch.column(1), batch.num_rows, np.uint8)
            margin = batch.column(3).to_numpy() + rate * sum(t.predict(bins) for t in trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], names=["row", "bins", "y", "margin"])


@dataclass
class Portion:
    """Open nodes that are worked in one pass: the trees, the trees' numbers, features and (tree, node) slots."""

    trees: list[Tree]
    numbers: list[int]
    features: list[list[int]]
    slots: list[tuple[int, int]]


def _summed(
    batches: Iterator[pa.RecordBatch], portion: Portion, before: list[Tree], growth: Growth, width: int
) -> Iterator[pa.RecordBatch]:
    """Gradients, hessians and rows of this task per slot, feature and bin."""
    total = np.zeros((len(portion.slots), width, growth.bins, 3))
    slot_of = [np.full(len(t.feature), -1) for t in portion.trees]
    for slot, (t, node) in enumerate(portion.slots):
        slot_of[t][node] = slot
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.column(0).to_numpy()
        bins = _matrix(batch.column(1), batch.num_rows, np.uint8)
        gradient = batch.column(3).to_numpy() - batch.column(2).to_numpy()
        if before:
            gradient = gradient + growth.rate * sum(t.predict(bins) for t in before)
        for t, tree in enumerate(portion.trees):
            weight = growth.weights(rows, portion.numbers[t])
            slot = np.where(weight > 0, slot_of[t][tree.place(bins)], -1)
            own = np.flatnonzero(slot >= 0)
            measures = (weight[own] * gradient[own], weight[own], np.ones(len(own)))
            for f in portion.features[t]:
                key = slot[own] * growth.bins + bins[own, f]
                for i, measure in enumerate(measures):
                    total[:, f, :, i] += np.bincount(key, measure, len(portion.slots) * growth.bins).reshape(-1, growth.bins)
    slots, cells, sums = [], [], []
    for slot, own in enumerate(total.reshape(len(portion.slots), -1, 3)):
        known = np.flatnonzero(own[:, 2])
        if len(known):
            slots.append(slot)
            cells.append(known.astype(np.int32))
            sums.append(own[known].ravel())
    columns = [pa.array(slots, pa.int32()), pa.array(cells, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["slot", "cells", "sums"])


def best_split(sums: np.ndarray, order: list[int], compete: int, growth: Growth) -> tuple[int, int, float]:
    """Feature, cut and gain of the best split of (feature, bin, measure) sums; feature -1 if there is none."""
    whole = sums[order[0]].sum(axis=0)
    left = np.cumsum(sums, axis=1)[:, :-1]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sum(s[..., 0] ** 2 / (s[..., 1] + growth.penalty) for s in (left, right)) - whole[0] ** 2 / (whole[1] + growth.penalty)
    fits = (left[..., 2] >= max(growth.least_leaf, 1)) & (right[..., 2] >= max(growth.least_leaf, 1))
    gain = np.where(fits, gain, -np.inf)
    best = (-1, 0, -np.inf)
    for i, f in enumerate(order):
        if i >= compete and best[0] >= 0:
            break
        cut = int(np.argmax(gain[f])) if gain.shape[1] else 0
        if gain.shape[1] and gain[f, cut] > max(best[2], LEAST_GAIN):
            best = (f, cut, float(gain[f, cut]))
    return best


def _split(batches: Iterator[pa.RecordBatch], orders: list[tuple[list[int], int]], growth: Growth, width: int) -> Iterator[pa.RecordBatch]:
    """The best split of every slot; all sums of a slot follow one another."""

    def result(slot: int, total: np.ndarray) -> pa.RecordBatch:
        sums = total.reshape(width, growth.bins, 3)
        order, compete = orders[slot]
        feature, cut, gain = best_split(sums, order, compete, growth)
        left = sums[feature, : cut + 1].sum(axis=0) if feature >= 0 else np.zeros(3)
        whole = sums[order[0]].sum(axis=0)
        columns = [
            pa.array([slot], pa.int32()), pa.array([feature], pa.int32()), pa.array([cut], pa.int32()), pa.array([gain]),
            pa.array([left], pa.list_(pa.float64())), pa.array([whole], pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["slot", "feature", "cut", "gain", "left", "whole"])

    slot, total = None, np.zeros((width * growth.bins, 3))
    for batch in batches:
        for number, cells, sums in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if number != slot:
                if slot is not None:
                    yield result(slot, total)
                slot, total = number, np.zeros((width * growth.bins, 3))
            total[cells.values.to_numpy()] += sums.values.to_numpy().reshape(-1, 3)
    if slot is not None:
        yield result(slot, total)


def _grow(rows: DataFrame, numbers: Sequence[int], before: list[Tree], growth: Growth, width: int) -> list[Tree]:
    """The trees with these numbers, grown side by side."""
    trees = [Tree() for _ in numbers]
    features = [growth.features(n, width) for n in numbers]
    open_ = [(t, 0) for t in range(len(trees))]
    at_once = max(1, CELLS // (width * growth.bins))
    for depth in range(growth.depth + 1):
        reached: list[tuple[int, int]] = []
        for start in range(0, len(open_), at_once):
            portion = Portion(trees, list(numbers), features, open_[start : start + at_once])
            orders = [growth.order(numbers[t], node, features[t]) for t, node in portion.slots]
            sums = rows.mapInArrow(lambda b, p=portion: _summed(b, p, before, growth, width), SUMS)
            dealt = sums.repartition("slot").sortWithinPartitions("slot")
            for r in dealt.mapInArrow(lambda b, o=orders: _split(b, o, growth, width), SPLITS).collect():
                t, node = portion.slots[r.slot]
                left, whole = np.array(r.left), np.array(r.whole)
                if node == 0:
                    trees[t].value[0] = _value(whole, growth)
                if depth < growth.depth and r.feature >= 0 and whole[2] >= growth.least_split:
                    right = whole - left
                    child = trees[t].split(node, r.feature, r.cut, (_value(left, growth), _value(right, growth)))
                    least = max(growth.least_split, 2 * growth.least_leaf, 2)
                    reached += [(t, c) for c, side in ((child, left), (child + 1, right)) if side[2] >= least]
        open_ = sorted(reached) if depth + 1 < growth.depth else []
        if not open_:
            return trees
    return trees


def _value(sums: np.ndarray, growth: Growth) -> float:
    return float(-sums[0] / (sums[1] + growth.penalty)) if sums[1] + growth.penalty else 0.0


class TreesModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Grown trees, kept as text."""

    content = Param(Params._dummy(), "content", "edges, base, scale and trees as JSON", TypeConverters.toString)

    def __init__(self, content: str | None = None):
        super().__init__()
        if content is not None:
            self._set(content=content)

    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault("content"))["trees"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = json.loads(self.getOrDefault("content"))
        trees, edges, base, scale = self.trees(), kept["edges"], kept["base"], kept["scale"]

        @F.pandas_udf("double")
        def predict(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=float)
            bins = binned(np.stack(features.to_numpy()), edges)
            return pd.Series(base + scale * sum((t.predict(bins) for t in trees), np.zeros(len(bins))))

        return df.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))


class TreesRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Trees for one label, grown as a ``Growth`` says."""

    growth = Param(Params._dummy(), "growth", "a Growth as JSON", TypeConverters.toString)

    def __init__(self, growth: Growth | None = None):
        super().__init__()
        if growth is not None:
            self._set(growth=json.dumps(asdict(growth)))

    def setParams(self, **columns: str) -> TreesRegressor:  # noqa: N802
        return self._set(**columns)

    def _fit(self, df: DataFrame) -> TreesModel:
        growth = Growth(**json.loads(self.getOrDefault("growth")))
        label = F.col(self.getLabelCol()).cast("double")
        rows = df.where(label.isNotNull()).select(
            F.monotonically_increasing_id().alias("row"), vector_to_array(self.getFeaturesCol()).alias("x"), label.alias("y")
        )
        edges = bin_edges(rows, "x", growth.bins)
        n, mean = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
        base = float(mean or 0.0) if growth.from_mean else 0.0
        trees: list[Tree] = []
        if n and edges:
            table = written(rows.mapInArrow(lambda b: _bin_rows(b, edges, base), BINNED), "binned")
            for number in range(growth.rounds):
                since = number % ROUNDS_PER_TABLE
                if number and not since:
                    done = trees[-ROUNDS_PER_TABLE * growth.parallel :]
                    table = written(table.mapInArrow(lambda b, d=done: _moved(b, d, growth.rate), BINNED), "binned")
                before = trees[len(trees) - since :] if since else []
                for first in range(0, growth.parallel, TREES_AT_ONCE):
                    numbers = range(number * growth.parallel + first, number * growth.parallel + min(first + TREES_AT_ONCE, growth.parallel))
                    trees += _grow(table, numbers, before, growth, len(edges))
        scale = growth.rate if growth.rounds > 1 else growth.rate / growth.parallel
        content = {"edges": edges, "base": base, "scale": scale, "trees": [asdict(t) for t in trees]}
        model = TreesModel(json.dumps(content))
        return model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
