"""Gradient-boosted quantile trees, grown for all quantiles and all folds at once.

Features are cut into bins once, a missing value in a bin of its own. A level of a tree takes one job over the rows: for every
model, node, feature and bin it counts the rows and those that lie below the present prediction, which is all that the pinball
loss's gradient needs. Tasks add up their counts in tables whose size depends on the models alone. Each node takes the split of
the largest gain, and with it the side to which missing values go. When a tree has its depth, one more job gives its leaves the
quantile of what is left to explain there.

A model belongs to a quantile and to a fold, and learns from the rows of earlier folds; one more learns from all rows. They grow
side by side in the same jobs, so the number of jobs depends on trees and depth, not on folds.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.operators.scoring import QUANTILES, monotone
from sparkcast.sources.scratch import scratch_path

#: The fold of the model that learns from all rows.
ALL = 2**31 - 1
_LEVELS = np.array(list(QUANTILES.values()))


@dataclass
class Trees:
    """The trees of one model: for each inner node, in heap order, the feature (-1: no split, all go left), the last bin that
    goes left and whether missing values do; then the leaves' values, from the left."""

    base: float = 0.0
    feature: list[list[int]] = field(default_factory=list)
    last: list[list[int]] = field(default_factory=list)
    missing: list[list[bool]] = field(default_factory=list)
    leaves: list[list[float]] = field(default_factory=list)

    def nodes(self, bins: np.ndarray, tree: int, depth: int, none: int) -> np.ndarray:
        """The node of each row after `depth` splits, counted from 0 in its level."""
        feature, last, missing = (np.array(x[tree]) for x in (self.feature, self.last, self.missing))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for level in range(depth):
            node = at + (1 << level) - 1
            b = bins[rows, np.maximum(feature[node], 0)]
            left = (feature[node] < 0) | np.where(b == none, missing[node], b <= last[node])
            at = 2 * at + ~left
        return at

    def values(self, bins: np.ndarray, depth: int, none: int) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree, leaves in enumerate(self.leaves):
            out += np.array(leaves)[self.nodes(bins, tree, depth, none)]
        return out


def best_splits(below: np.ndarray, rows: np.ndarray, level: float, least: int) -> list[tuple[int, int, bool]]:
    """For each node (feature, last bin on the left, missing to the left) of the largest gain; feature -1 if no split gains.

    below and rows are counts by node, feature and bin, the last bin being for missing values. The gain is that of fitting the
    mean gradient on either side; equal gains go to the first feature and bin.
    """
    pull = level * rows - below  # minus the gradient's sum
    out = []
    for node in range(len(rows)):
        total, n = pull[node, 0].sum(), rows[node, 0].sum()
        best = (1e-9, -1, 0, True)
        for left in (True, False):
            s = pull[node, :, :-1].cumsum(axis=1) + (pull[node, :, -1:] if left else 0)
            k = rows[node, :, :-1].cumsum(axis=1) + (rows[node, :, -1:] if left else 0)
            fits = (k >= least) & (n - k >= least)
            gain = np.where(fits, s**2 / np.maximum(k, 1) + (total - s) ** 2 / np.maximum(n - k, 1) - total**2 / max(n, 1), 0.0)
            at = int(gain.argmax())
            if gain.flat[at] > best[0]:
                best = (float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1], left)
        out.append(best[1:])
    return out


@dataclass
class BoostedQuantiles:
    """Boosted trees for q10, q50 and q90. With a `fold` column, models of folds are fitted besides the one of all rows."""

    features: list[str]
    target: str
    fold: str | None = None
    trees: int = 20
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    least: int = 20
    edges: list[list[float]] = field(default_factory=list)
    models: dict[tuple[int, int], Trees] = field(default_factory=dict)

    def _binned(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.uint8)
        for k, (x, edges) in enumerate(zip(columns, self.edges, strict=True)):
            out[:, k] = np.where(np.isnan(x), self.bins, np.searchsorted(edges, x, "left"))
        return out

    def _inputs(self, df: DataFrame) -> list:
        return [F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(self.features)]

    def fit(self, df: DataFrame) -> BoostedQuantiles:
        """NULL targets take no part. An empty table, or a fold without earlier rows, gives predictions of 0."""
        spark = df.sparkSession
        fold = F.col(self.fold).cast("int") if self.fold else F.lit(0)
        rows = df.where(F.col(self.target).isNotNull()).select(fold.alias("fold"), F.col(self.target).cast("double").alias("y"), *self._inputs(df))
        cuts = [k / self.bins for k in range(1, self.bins)]
        facts = rows.agg(F.collect_set("fold").alias("folds"), *(F.percentile_approx(F.nanvl(f"x{k}", F.lit(None)), cuts, 10_000).alias(f"e{k}") for k in range(len(self.features)))).first()
        self.edges = [sorted(set(facts[f"e{k}"] or [])) for k in range(len(self.features))]
        folds = [*sorted(f for f in facts.folds if f > 0 and self.fold), ALL]
        self.models = {(f, q): Trees() for f in folds for q in range(len(QUANTILES))}

        def binned(batches):
            for batch in batches:
                x = self._binned([batch.column(2 + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(self.features))])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["fold", "y", "x"])

        path = scratch_path(spark, "bins")
        rows.mapInArrow(binned, "fold int, y double, x binary").write.parquet(path)
        rows = spark.read.schema("fold int, y double, x binary").parquet(path)

        for (f, q), base in self._quantiles(rows, 0).items():
            self.models[f, q].base = base[0]
        inner = (1 << self.depth) - 1
        for tree in range(self.trees):
            for m in self.models.values():
                m.feature.append([-1] * inner)
                m.last.append([0] * inner)
                m.missing.append([True] * inner)
            for level in range(self.depth):
                for (f, q), (below, n) in self._counts(rows, tree, level).items():
                    m, first = self.models[f, q], (1 << level) - 1
                    for k, (feature, last, missing) in enumerate(best_splits(below, n, _LEVELS[q], self.least)):
                        m.feature[tree][first + k], m.last[tree][first + k], m.missing[tree][first + k] = feature, last, missing
            found = self._quantiles(rows, self.depth)
            for key, m in self.models.items():
                m.leaves.append([self.rate * v for v in found.get(key, [0.0] * (1 << self.depth))])
        return self

    def _parts(self, batch: pa.RecordBatch):
        """Yields (fold, quantile, trees, bins, rest) for each model and the rows that it learns from; rest is what its trees
        don't explain yet."""
        folds, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        bins = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(y), -1)
        for (f, q), m in self.models.items():
            own = folds < f
            if own.any():
                yield f, q, m, bins[own], y[own] - m.values(bins[own], self.depth, self.bins)

    def _counts(self, rows: DataFrame, tree: int, level: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """For each model the counts of rows below and of all rows by node of a level, feature and bin."""
        shape, width = (1 << level, len(self.features), self.bins + 1), self.bins + 1

        def table(found: dict[tuple[int, int], np.ndarray]):
            keys = list(found)
            return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)] + [pa.array([found[k].tobytes() for k in keys], pa.binary())], ["f", "q", "n"])

        def count(batches):
            found: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for f, q, m, bins, rest in self._parts(batch):
                    slot = (m.nodes(bins, tree, level, self.bins)[:, None] * shape[1] + np.arange(shape[1])) * width + bins
                    both = [np.bincount(s.ravel(), minlength=int(np.prod(shape))) for s in (slot[rest < 0], slot)]
                    found[f, q] = found.get((f, q), 0) + np.stack(both)
            if found:
                yield table(found)

        def add(batches):
            found: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for f, q, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    found[f, q] = found.get((f, q), 0) + np.frombuffer(n, np.int64)
            if found:
                yield table(found)

        schema = "f int, q int, n binary"
        added = rows.mapInArrow(count, schema).repartition(8, "f", "q").mapInArrow(add, schema).collect()  # a row for each model
        return {(r.f, r.q): tuple(np.frombuffer(r.n, np.int64).reshape(2, *shape)) for r in added}

    def _quantiles(self, rows: DataFrame, depth: int) -> dict[tuple[int, int], list[float]]:
        """For each model its quantile of the rest in each leaf of the tree that is being grown; 0 in empty leaves."""

        def rest(batches):
            for batch in batches:
                for f, q, m, bins, left in self._parts(batch):
                    leaf = m.nodes(bins, len(m.leaves), depth, self.bins) if depth else np.zeros(len(left), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(left), f, np.int32)), pa.array(np.full(len(left), q, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(left)], ["f", "q", "leaf", "rest"])

        levels = F.percentile_approx("rest", _LEVELS.tolist(), 10_000)
        found = rows.mapInArrow(rest, "f int, q int, leaf int, rest double").groupBy("f", "q", "leaf").agg(F.get(levels, F.first("q")).alias("v")).collect()
        out = {key: [0.0] * (1 << depth) for key in self.models}
        for r in found:
            out[r.f, r.q][r.leaf] = r.v
        return out

    def predict(self, df: DataFrame, by_fold: bool = False) -> DataFrame:
        """df with q10, q50 and q90, in order: from the model of all rows, or from that of each row's fold, for rows in one."""
        rows = df.drop(*QUANTILES)
        if by_fold:
            rows = rows.where(F.col(self.fold) > 0)
        names, n = rows.columns, len(rows.columns)
        given = rows.select(*names, *self._inputs(rows))
        schema = T.StructType([*rows.schema.fields, *(T.StructField(q, T.DoubleType()) for q in QUANTILES)])

        def run(batches):
            for batch in batches:
                bins = self._binned([batch.column(n + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(self.features))])
                fold = batch.column(names.index(self.fold)).to_numpy() if by_fold else np.full(batch.num_rows, ALL)
                out = np.zeros((len(QUANTILES), batch.num_rows))
                for (f, q), m in self.models.items():
                    own = fold == f
                    if own.any():
                        out[q, own] = m.values(bins[own], self.depth, self.bins)
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *map(pa.array, out)], [*names, *QUANTILES])

        return monotone(given.mapInArrow(run, schema), list(QUANTILES))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(f, q, json.dumps(vars(m))) for (f, q), m in self.models.items()]
        spark.createDataFrame([(-1, -1, json.dumps(self.edges)), *rows], "fold int, quantile int, model string").coalesce(1).write.mode("overwrite").parquet(path)

    def load(self, spark: SparkSession, path: str) -> BoostedQuantiles:
        self.models = {}
        for r in spark.read.parquet(path).collect():  # a row for each model
            if r.fold < 0:
                self.edges = json.loads(r.model)
            else:
                self.models[r.fold, r.quantile] = Trees(**json.loads(r.model))
        return self
