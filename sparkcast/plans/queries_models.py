"""Queries of the quantile models. Fitted trees depend on row order, so these have no SQL equivalent but the last."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.operators import features, scoring
from sparkcast.operators.boosting import BoostedQuantiles
from sparkcast.operators.models import SUMMARY, QuantileForest, QuantileLinear, Stack, fit_stack, sequence_summary, walk_forward
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS
from sparkcast.plans.queries_features import H, build_gold
from sparkcast.plans.register import query
from sparkcast.sources.scratch import scratch_path

IDS = ["region", "ts"]
#: Blocks of time; the last one is held out, so stacks have FOLDS - 1 out-of-fold blocks.
FOLDS = 5
TABULAR = ["half_hour", "dow", "clearsky_cos", "ssrd", "tcc", "gen_lag_24", "gen_lag_48", "gen_lag_96", "gen_roll_mean_48", "gen_roll_std_48"]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with the summary of the sequence known at the horizon. Written once."""
    known = feeds.spine(spark, sf_dir).select(*IDS, F.coalesce("total", F.lit(0.0)).alias("x"))
    summary = sequence_summary(features.sequence_windows(known, KEYS, ["x"], 48, contiguous_step=30)).select("region", (F.col("ts") + F.expr(f"INTERVAL '{30 * H}' MINUTE")).alias("ts"), *SUMMARY)
    return _stored(build_gold(spark, sf_dir).join(summary, IDS, "left"), "gold")


def training_table(rows: DataFrame) -> DataFrame:
    """The rows that models learn from and are scored on: daylight, a full history, a known target and a known main driver; with
    their folds."""
    return _stored(scoring.time_folds(features.training_rows(scoring.daylight_only(rows), "target_mw", "ssrd"), FOLDS, KEYS), "model")


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_table(model_rows(spark, sf_dir))


def boosted() -> BoostedQuantiles:
    return BoostedQuantiles(TABULAR, "target_mw", "fold")


def boosted_sequences() -> BoostedQuantiles:
    return BoostedQuantiles([*SUMMARY, "half_hour", "clearsky_cos"], "target_mw", "fold")


def forest() -> QuantileForest:
    return QuantileForest(TABULAR, "target_mw", IDS)


def sequence_forest() -> QuantileForest:
    return QuantileForest([*SUMMARY, "half_hour", "clearsky_cos"], "target_mw", IDS)


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*IDS, "target_mw", *scoring.QUANTILES)


@query()
def qforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = model_table(spark, sf_dir)
    return _shown(forest().fit(t.where(f"fold < {FOLDS}")).predict(t.where(f"fold = {FOLDS}")))


@query()
def qseq(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = model_table(spark, sf_dir)
    return _shown(sequence_forest().fit(t.where(f"fold < {FOLDS}")).predict(t.where(f"fold = {FOLDS}")))


@query()
def qlinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = model_table(spark, sf_dir)
    model = QuantileLinear(["gen_lag_24", "gen_lag_48", "gen_roll_mean_48", "clearsky_cos"], "target_mw")
    return _shown(model.fit(t.where(f"fold < {FOLDS}")).predict(t.where(f"fold = {FOLDS}")))


@query()
def qboost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on the held-out fold."""
    t = model_table(spark, sf_dir)
    model = BoostedQuantiles(TABULAR, "target_mw")
    return _shown(model.fit(t.where(f"fold < {FOLDS}")).predict(t.where(f"fold = {FOLDS}")))


def _stack(t: DataFrame) -> Stack:
    return fit_stack(t.where(f"fold < {FOLDS}"), boosted(), boosted_sequences(), "clearsky_ghi")


@query()
def stack_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meta-learner's weights after fitting on out-of-fold quantiles, with the number of rows of the table."""
    t = model_table(spark, sf_dir)
    stack = _stack(t)
    rows = [(q, name, float(w)) for q, ws in stack.meta.weights.items() for name, w in zip(["intercept", *stack.meta.features], ws, strict=True)]
    used = t.where(f"fold < {FOLDS}").agg(F.count("*").alias("n_rows"))
    return spark.createDataFrame(rows, "quantile string, input string, weight double").join(F.broadcast(used), F.lit(True))  # one row


@query()
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stack fitted, saved and loaded again, over the whole table: quantiles in order, nights at 0."""
    rows, path = model_rows(spark, sf_dir), scratch_path(spark, "stack")
    _stack(training_table(rows)).save(spark, path)
    stack = Stack(boosted(), boosted_sequences(), QuantileLinear(Stack.inputs("clearsky_ghi"), "target_mw"), "clearsky_ghi").load(spark, path)
    known = rows.where("gen_lag_48 is not null and target_mw is not null")
    return scoring.night_zero(stack.predict(known), list(scoring.QUANTILES)).select(*IDS, "target_mw", "is_daylight", *scoring.QUANTILES)


@query()
def walk_forward_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = model_table(spark, sf_dir)
    cutoffs = [datetime.datetime(2024, 1, day) for day in (15, 20, 25)]
    return walk_forward(t, cutoffs, BoostedQuantiles(TABULAR, "target_mw", "passed")).select(*IDS, "cutoff", "target_mw", *scoring.QUANTILES)
