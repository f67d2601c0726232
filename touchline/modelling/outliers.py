"""Isolation forest: trees from small samples, scores for all rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.modelling.trees import uniform
from touchline.operators.ranking import first_rows

# Trees, rows per tree, score above which a row is an outlier.
TREES = 100
SAMPLE = 256
OUTLIER_SCORE = 0.5

SAMPLED = "tree int, _draw double, _key long, row array<double>"
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, length double"


def _path_correction(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(rows: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, length); leaves have feature -1 and a path length."""
    nodes: list[tuple] = []
    open_nodes = [(0, rows, 0)]
    taken = 1
    while open_nodes:
        number, part, depth = open_nodes.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        spread = np.flatnonzero(high > low)
        if depth >= depth_limit or len(part) <= 1 or not len(spread):
            nodes.append((number, -1, 0.0, -1, -1, depth + _path_correction(len(part))))
            continue
        feature = int(rng.choice(spread))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        nodes.append((number, feature, threshold, taken, taken + 1, 0.0))
        open_nodes += [(taken, part[goes_left], depth + 1), (taken + 1, part[~goes_left], depth + 1)]
        taken += 2
    return nodes


@dataclass
class IsolationForest:
    """A grown forest: one array per node attribute, padded to the largest tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    sample: int

    def score(self, features: Column) -> Column:
        """Score in (0, 1); higher is more isolated."""
        forest = self

        @F.pandas_udf("double")
        def scores(batch: pd.Series) -> pd.Series:
            return pd.Series(forest.scores(np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 1))))

        return scores(vector_to_array(features))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Scores of the rows of a matrix.

        A leaf is its own left child below an infinite threshold, so every row takes as many steps as the
        forest is deep and none is asked whether it has arrived. NaN goes right, as infinity does.
        """
        leaf = self.feature < 0
        feature = np.where(leaf, 0, self.feature)
        threshold = np.where(leaf, np.inf, self.threshold)
        left = np.where(leaf, np.arange(self.feature.shape[1]), self.left)
        values = np.where(np.isnan(rows), np.inf, rows).ravel()
        starts = np.arange(len(rows)) * rows.shape[1]
        total = np.zeros(len(rows))
        for t in range(len(feature)):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depths[t]):
                # The right child follows the left one.
                goes_right = values.take(feature[t].take(node) + starts) > threshold[t].take(node)
                node = left[t].take(node) + goes_right
            total += self.length[t].take(node)
        mean = total / max(len(feature), 1)
        return 2.0 ** (-mean / max(_path_correction(self.sample), 1e-12))

    @cached_property
    def depths(self) -> list[int]:
        """Steps from the root to the deepest leaf of every tree."""
        found = []
        for feature, left, right in zip(self.feature, self.left, self.right):
            level, depth = np.array([0]), 0
            while True:
                inner = level[feature[level] >= 0]
                if not len(inner):
                    break
                level, depth = np.concatenate([left[inner], right[inner]]), depth + 1
            found.append(depth)
        return found


def _sampled(batches: Iterator[pa.RecordBatch], trees: int, seed: int, sample: int) -> Iterator[pa.RecordBatch]:
    """The rows of this task with the smallest draws of every tree, at most ``sample`` a tree."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * trees
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
        keys = batch.column(1).to_numpy()
        for t in range(trees):
            draw = uniform(keys, seed, t)
            if held[t] is not None and len(held[t][0]) >= sample:
                own = np.flatnonzero(draw <= held[t][0][-1])
            elif len(draw) > sample:
                # No row beyond the batch's own least draws can be among the least of all.
                own = np.flatnonzero(draw <= np.partition(draw, sample - 1)[sample - 1])
            else:
                own = np.arange(len(draw))
            if not len(own):
                continue
            parts = (draw[own], keys[own], rows[own])
            if held[t] is not None:
                parts = tuple(np.concatenate(p) for p in zip(held[t], parts))
            order = np.lexsort((parts[1], parts[0]))[:sample]
            held[t] = tuple(p[order] for p in parts)
    for t, own in enumerate(held):
        if own is not None:
            columns = [
                pa.array(np.full(len(own[0]), t, np.int32)), pa.array(own[0]), pa.array(own[1]),
                pa.FixedSizeListArray.from_arrays(pa.array(own[2].ravel()), own[2].shape[1]).cast(pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "_draw", "_key", "row"])


def fit_isolation_forest(df: DataFrame, features: str = "features", trees: int = TREES, seed: int = 42) -> IsolationForest:
    """Grow ``trees`` trees, each from its own sample of min(256, rows) rows.

    A hash of a whole row, the tree and the seed orders all rows, so the samples are the same on
    any cluster; rows equal in all columns come together. In one pass every task keeps the rows with
    the smallest draws of each tree, so no row is copied for a tree, and at most 256 of a task and
    tree are shuffled. The nodes, at most 511 per tree, come back.
    """
    whole = F.xxhash64(*[vector_to_array(c) if c == features else F.col(c) for c in df.columns])
    rows = df.select(vector_to_array(features).alias("row"), whole.alias("_key"))
    n = rows.count()
    sample = min(SAMPLE, n)
    least = rows.mapInArrow(lambda b: _sampled(b, trees, seed, sample), SAMPLED)
    picked = first_rows(least, ["tree"], [F.asc("_draw"), F.asc("_key")], sample).select("tree", "row", "_draw", "_key")
    depth_limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        ordered = group.sort_values(["_draw", "_key"])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(np.stack(ordered["row"].to_numpy()), rng, depth_limit)
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "length"])
        frame.insert(0, "tree", tree)
        return frame

    nodes = picked.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    width = int(nodes["node"].max()) + 1 if len(nodes) else 1
    numbers = {t: i for i, t in enumerate(sorted(nodes["tree"].unique()))}
    place = (nodes["tree"].map(numbers).to_numpy(), nodes["node"].to_numpy())

    def spread(column: str, empty: float, kind: type) -> np.ndarray:
        out = np.full((len(numbers), width), empty, dtype=kind)
        out[place] = nodes[column].to_numpy()
        return out

    return IsolationForest(
        spread("feature", -1, np.int64),
        spread("threshold", 0.0, np.float64),
        spread("left", -1, np.int64),
        spread("right", -1, np.int64),
        spread("length", 0.0, np.float64),
        sample,
    )


def drop_outliers(df: DataFrame, features: str = "features", seed: int = 42, trees: int = TREES) -> DataFrame:
    """Rows whose isolation score does not exceed one half."""
    forest = fit_isolation_forest(df, features, trees, seed)
    return df.where(forest.score(F.col(features)) <= OUTLIER_SCORE)
