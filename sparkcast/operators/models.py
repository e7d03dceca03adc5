"""Distributed quantile models: a leaf-quantile forest, a linear quantile meta-learner, stacks of boosted trees, walk-forward
runs.

Forecasters here have `fit` and `predict`; a prediction adds q10, q50 and q90. Rows are known by `ids`, unique columns.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.operators.boosting import BoostedQuantiles
from sparkcast.operators.scoring import QUANTILES, monotone


@dataclass
class QuantileForest:
    """A random forest whose leaves hold the quantiles of their training targets; a prediction averages them over trees.

    NULL features are imputed by the mean and flagged by an indicator. There are at most trees * 2**depth leaves, so their
    table is small however many rows there are.
    """

    features: list[str]
    target: str
    ids: list[str]
    trees: int = 10
    depth: int = 5
    seed: int = 7
    _model: PipelineModel | None = field(default=None, repr=False)
    _leaves: DataFrame | None = field(default=None, repr=False)

    def _inputs(self, df: DataFrame) -> DataFrame:
        flags = {f"{c}_missing": F.col(c).isNull().cast("double") for c in self.features}
        return df.withColumns(flags | {f"{c}_value": F.col(c).cast("double") for c in self.features})

    def _leaf_rows(self, df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*columns, F.posexplode(vector_to_array("_leaf")).alias("tree", "leaf"))

    def fit(self, df: DataFrame) -> QuantileForest:
        rows = self._inputs(df.where(F.col(self.target).isNotNull()))
        values, flags = [f"{c}_value" for c in self.features], [f"{c}_missing" for c in self.features]
        known = rows.agg(*(F.count(c).alias(c) for c in values)).first().asDict()
        filled = [f"{c}_filled" for c in values if known[c]]
        stages = [Imputer(inputCols=[c for c in values if known[c]], outputCols=filled)] if filled else []
        stages.append(VectorAssembler(inputCols=[*filled, *flags], outputCol="_x"))
        stages.append(RandomForestRegressor(featuresCol="_x", labelCol=self.target, leafCol="_leaf", numTrees=self.trees, maxDepth=self.depth, seed=self.seed))
        self._model = Pipeline(stages=stages).fit(rows)
        levels = list(QUANTILES.values())
        leaves = self._leaf_rows(self._model.transform(rows), self.target).groupBy("tree", "leaf").agg(F.percentile_approx(self.target, levels, 10000).alias("q"))
        self._leaves = df.sparkSession.createDataFrame(leaves.collect(), leaves.schema)
        return self

    @property
    def importances(self) -> list[float]:
        return self._model.stages[-1].featureImportances.toArray().tolist()

    def predict(self, df: DataFrame) -> DataFrame:
        """Quantiles averaged over the trees' leaves. The leaves come in as one row of nested arrays, so nothing is shuffled."""
        sizes = self._leaves.groupBy("tree").agg(F.max("leaf").cast("int").alias("last"), F.map_from_entries(F.collect_list(F.struct(F.col("leaf").cast("int").alias("leaf"), "q"))).alias("m"))
        trees = sizes.select("tree", F.transform(F.sequence(F.lit(0), F.col("last")), lambda k: F.element_at("m", k)).alias("q"))
        forest = trees.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "q"))), lambda t: t["q"]).alias("_forest"))
        rows = df.drop(*QUANTILES)
        at = self._model.transform(self._inputs(rows)).join(F.broadcast(forest), F.lit(True))  # one row
        found = F.transform(vector_to_array("_leaf"), lambda leaf, tree: F.get(F.get(F.col("_forest"), tree), leaf.cast("int")))
        at = at.select(*rows.columns, F.filter(found, lambda q: q.isNotNull()).alias("_found"))
        mean = lambda k: F.aggregate("_found", F.lit(0.0), lambda a, q: a + F.get(q, F.lit(k))) / F.nullif(F.size("_found"), F.lit(0))
        return at.withColumns({q: mean(k) for k, q in enumerate(QUANTILES)}).drop("_found")

    def save(self, path: str) -> None:
        self._model.write().overwrite().save(f"{path}/forest")
        self._leaves.write.mode("overwrite").parquet(f"{path}/leaves")

    def load(self, spark, path: str) -> QuantileForest:
        self._model, self._leaves = PipelineModel.load(f"{path}/forest"), spark.read.parquet(f"{path}/leaves")
        return self


@dataclass
class QuantileLinear:
    """Linear quantile regression by majorise-minimise steps (Hunter and Lange 2000), all quantiles at once.

    Each step is one aggregate that gives X'WX and X'Wy for every quantile; systems of a few unknowns are solved on the driver.
    """

    features: list[str]
    target: str
    steps: int = 40
    tolerance: float = 1e-5
    weights: dict[str, list[float]] = field(default_factory=dict)

    def _terms(self) -> list[Column]:
        return [F.lit(1.0), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features)]

    def _value(self, weights: list[float]) -> Column:
        return sum((F.lit(float(w)) * x for w, x in zip(weights[1:], self._terms()[1:], strict=True)), F.lit(float(weights[0])))

    def fit(self, df: DataFrame) -> QuantileLinear:
        p = len(self.features) + 1
        inputs = [x.alias(f"x{i}") for i, x in enumerate(self._terms())]
        rows = df.where(F.col(self.target).isNotNull()).select(*inputs, F.col(self.target).cast("double").alias("y")).persist()
        pairs = [(i, j) for i in range(p) for j in range(i + 1)]
        first = rows.agg(F.avg(F.abs("y")).alias("s"), *(F.sum(f"x{i}").alias(f"t{i}") for i in range(p))).first()
        self.weights, last = {q: [0.0] * p for q in QUANTILES}, np.inf
        totals = np.array([first[f"t{i}"] or 0.0 for i in range(p)])
        names = [f"w_{q}_{i}" for q in QUANTILES for i in range(p)] + ["eps"]
        # weights come in as a one-row table, not as literals, so that all steps share one plan and its compiled code
        sums: list[Column] = []
        residuals = {}
        for q, level in QUANTILES.items():
            r = f"r_{q}"
            residuals[r] = F.col("y") - sum((F.col(f"w_{q}_{i}") * F.col(f"x{i}") for i in range(1, p)), F.col(f"w_{q}_0"))
            w = F.col(f"v_{q}")
            sums += [F.sum(w * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"{q}_{i}_{j}") for i, j in pairs]
            sums += [F.sum(w * F.col(f"x{i}") * F.col("y")).alias(f"{q}_y_{i}") for i in range(p)]
            sums.append(F.avg(F.greatest(level * F.col(r), (level - 1) * F.col(r))).alias(f"{q}_loss"))
        for _ in range(self.steps if first.s is not None else 0):
            values = [float(w) for q in QUANTILES for w in self.weights[q]] + [1e-4 * (first.s or 1.0)]
            given = df.sparkSession.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))
            step = rows.join(F.broadcast(given), F.lit(True)).withColumns(residuals)  # one row
            got = step.withColumns({f"v_{q}": 1 / (F.col("eps") + F.abs(f"r_{q}")) for q in QUANTILES}).agg(*sums).first()
            for q, level in QUANTILES.items():
                a = np.zeros((p, p))
                for i, j in pairs:
                    a[i, j] = a[j, i] = got[f"{q}_{i}_{j}"]
                b = np.array([got[f"{q}_y_{i}"] for i in range(p)]) + (2 * level - 1) * totals
                self.weights[q] = np.linalg.lstsq(a + 1e-9 * np.eye(p) * np.trace(a) / p, b, rcond=None)[0].tolist()
            loss = sum(got[f"{q}_loss"] for q in QUANTILES)
            if np.isfinite(last) and last - loss < self.tolerance * abs(loss):
                break
            last = loss
        rows.unpersist()
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """Quantiles sorted in each row, so that they never cross."""
        return monotone(df.drop(*QUANTILES).withColumns({q: self._value(w) for q, w in self.weights.items()}), list(QUANTILES))


def sequence_summary(df: DataFrame, sequence: str = "sequence") -> DataFrame:
    """mean, deviation, last value and slope of a sequence's first feature, by array functions."""
    x = F.transform(sequence, lambda r: F.get(r, F.lit(0)).cast("double"))
    out = df.withColumn("_x", x)
    n = F.size("_x")
    mean = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v) / n
    out = out.withColumn("seq_mean", mean)
    var = F.aggregate("_x", F.lit(0.0), lambda a, v: a + (v - F.col("seq_mean")) * (v - F.col("seq_mean"))) / n
    moment = F.aggregate(F.transform("_x", lambda v, i: v * (i - (n - 1) / 2)), F.lit(0.0), lambda a, v: a + v)
    slope = moment * 12 / (n * (n * n - 1)).cast("double")
    return out.withColumns({"seq_std": F.sqrt(var), "seq_last": F.element_at("_x", -1), "seq_slope": slope}).drop("_x")


SUMMARY = ["seq_mean", "seq_std", "seq_last", "seq_slope"]


@dataclass
class Stack:
    """Two base models and a linear meta-learner fitted on their out-of-fold quantiles and the clear-sky irradiance."""

    first: BoostedQuantiles
    second: BoostedQuantiles
    meta: QuantileLinear
    sky: str

    @staticmethod
    def inputs(sky: str) -> list[str]:
        return [*(f"a_{q}" for q in QUANTILES), *(f"b_{q}" for q in QUANTILES), sky]

    def _design(self, df: DataFrame, by_fold: bool = False) -> DataFrame:
        a = self.first.predict(df, by_fold).withColumnsRenamed({q: f"a_{q}" for q in QUANTILES})
        return self.second.predict(a, by_fold).withColumnsRenamed({q: f"b_{q}" for q in QUANTILES})

    def predict(self, df: DataFrame) -> DataFrame:
        return self.meta.predict(self._design(df)).drop(*self.inputs(self.sky)[:6])

    def save(self, spark, path: str, metrics: DataFrame | None = None) -> None:
        """Both base models, the meta-learner's weights and, if given, the metrics of the run."""
        self.first.save(spark, f"{path}/first")
        self.second.save(spark, f"{path}/second")
        rows = [(q, k, float(w)) for q, ws in self.meta.weights.items() for k, w in enumerate(ws)]
        spark.createDataFrame(rows, "quantile string, k int, weight double").write.mode("overwrite").parquet(f"{path}/meta")
        if metrics is not None:
            metrics.write.mode("overwrite").parquet(f"{path}/metrics")

    def load(self, spark, path: str) -> Stack:
        self.first.load(spark, f"{path}/first")
        self.second.load(spark, f"{path}/second")
        self.meta.weights = {}
        for r in spark.read.parquet(f"{path}/meta").orderBy("quantile", "k").collect():
            self.meta.weights.setdefault(r.quantile, []).append(r.weight)
        return self


def save_scored(df: DataFrame, path: str, columns: list[str], target: str) -> None:
    """Scored slots of a run, with the name of the target that they are about, for later evaluation."""
    df.select(*columns, F.lit(target).alias("target")).write.mode("overwrite").parquet(path)


def metric_rows(report: DataFrame, by: list[str]) -> DataFrame:
    """A metric report in long form: (by..., metric, value)."""
    names = [c for c in report.columns if c not in by]
    return report.select(*by, F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names))))


def fit_stack(df: DataFrame, first: BoostedQuantiles, second: BoostedQuantiles, sky: str) -> Stack:
    """df has the models' fold column: fold i is predicted by models of the rows before it, those predictions fit the
    meta-learner, and base models of all rows go into the stack. All of a base model's folds are fitted together, and both base
    models side by side: neither needs the other, and a fit is a chain of short jobs that leaves executors idle between them."""
    with ThreadPoolExecutor(2) as pool:
        fits = [pool.submit(inheritable_thread_target(df.sparkSession)(model.fit), df) for model in (first, second)]
        stack = Stack(*(f.result() for f in fits), QuantileLinear(Stack.inputs(sky), first.target), sky)
    stack.meta.fit(stack._design(df, by_fold=True))
    return stack


def walk_forward(df: DataFrame, cutoffs: list, model: BoostedQuantiles, ts: str = "ts") -> DataFrame:
    """For each cutoff a model of the rows before it predicts those up to the next one; all are fitted together. `model.fold`
    names the column that gets the number of cutoffs passed, from 1."""
    passed = sum(((F.col(ts) >= F.lit(c)).cast("int") for c in cutoffs), F.lit(0))
    dealt = df.withColumn(model.fold, passed)
    out = model.fit(dealt).predict(dealt, by_fold=True)
    return out.withColumn("cutoff", F.element_at(F.array(*map(F.lit, cutoffs)), F.col(model.fold)))


def score_with(df: DataFrame, ids: list[str], schema: str, fn) -> DataFrame:
    """Any scorer over pandas batches: fn(pdf) gives a dict of arrays for q10, q50 and q90. schema has ids and quantiles."""

    def run(batches):
        for pdf in batches:
            yield pdf[ids].assign(**fn(pdf))

    return df.mapInPandas(run, schema)


def train_each(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """One small model per series: fn(pdf) trains on and scores a series, which must fit one task."""
    return df.groupBy(*keys).applyInPandas(fn, schema)
