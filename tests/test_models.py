"""Quantile models: order, calibration, round trip through files."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from sparkcast.operators.boosting import ALL, BoostedQuantiles
from sparkcast.operators.models import QuantileForest, QuantileLinear, Stack, fit_stack, metric_rows, score_with, walk_forward


def table(spark, n=600, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    y = 30 * x[:, 0] - 15 * x[:, 1] + rng.normal(3, 4, n)
    return spark.createDataFrame([(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, y double")


def shares(df):
    return [df.agg(F.avg((F.col("y") <= F.col(q)).cast("double"))).first()[0] for q in ("q10", "q50", "q90")]


def test_forest(spark, tmp_path):
    df = table(spark).withColumn("c", F.when(F.col("id") % 5 > 0, F.col("c")))
    model = QuantileForest(["a", "b", "c"], "y", ["id"], trees=5, depth=4).fit(df)
    out = model.predict(df)
    assert out.count() == 600 and out.where("q10 > q50 or q50 > q90").count() == 0
    assert np.allclose(shares(out), [0.1, 0.5, 0.9], atol=0.06) and len(model.importances) >= 3
    model.save(f"file://{tmp_path}/m")
    again = QuantileForest(["a", "b", "c"], "y", ["id"]).load(spark, f"file://{tmp_path}/m").predict(df)
    assert np.allclose([r.q50 for r in again.orderBy("id").collect()], [r.q50 for r in out.orderBy("id").collect()])


def pinball(rows, names=("q10", "q50", "q90")):
    return np.mean([np.mean([max(t * (r.y - r[q]), (t - 1) * (r.y - r[q])) for r in rows]) for q, t in zip(names, (0.1, 0.5, 0.9), strict=True)])


def small(fold=None, **k):
    return BoostedQuantiles(["a", "b"], "y", fold, trees=k.pop("trees", 3), depth=2, rate=0.5, bins=8, least=k.pop("least", 5), **k)


def splits_by_loops(x, y, now, level, bins, least):
    """The best split of all features, bins and sides for missing values, row by row."""
    best = (1e-9, -1, 0, True)
    for left in (True, False):
        for f in range(x.shape[1]):
            for b in range(bins):
                side = np.array([left if v == bins else v <= b for v in x[:, f]])
                if min(side.sum(), (~side).sum()) < least:
                    continue
                pull = np.array([level - (u < p) for u, p in zip(y, now, strict=True)])
                gain = pull[side].sum() ** 2 / side.sum() + pull[~side].sum() ** 2 / (~side).sum() - pull.sum() ** 2 / len(y)
                if gain > best[0] + 1e-12:
                    best = (gain, f, b, left)
    return best[1:]


def test_boosting_takes_the_splits_that_loops_take(spark):
    df = table(spark, 300).withColumn("a", F.when(F.col("id") % 3 > 0, F.col("a"))).repartition(5)
    model = small(trees=1).fit(df)
    rows = df.orderBy("id").collect()
    columns = [np.array([np.nan if r[c] is None else r[c] for r in rows]) for c in "ab"]
    x, y = model._binned(columns).astype(int), np.array([r.y for r in rows])
    for q, level in enumerate((0.1, 0.5, 0.9)):
        m = model.models[ALL, q]
        assert m.base == sorted(y)[int(np.ceil(len(y) * level)) - 1]
        node = np.zeros(len(y), int)
        for k in range(3):
            own = node == k
            got = (m.feature[0][k], m.last[0][k], m.missing[0][k])
            assert got == splits_by_loops(x[own], y[own], np.full(own.sum(), m.base), level, 8, 5)
            f, b, left = got
            node[own] = 2 * k + 1 + ~np.where(x[own, f] == 8, left, x[own, f] <= b) if f >= 0 else 2 * k + 1
        for leaf in range(4):
            rest = sorted(y[node == 3 + leaf] - m.base)
            assert m.leaves[0][leaf] == (0.5 * rest[max(0, int(np.ceil(len(rest) * level)) - 1)] if rest else 0.0)


def test_boosting_beats_the_forest_and_uses_missing_values(spark):
    df = table(spark, 1500).withColumn("a", F.when(F.col("a") < 0.7, F.col("a")))  # missing where the target is high
    past, held = df.where("id < 1000"), df.where("id >= 1000")
    boosted = BoostedQuantiles(["a", "b"], "y").fit(past).predict(held).collect()
    forest = QuantileForest(["a", "b"], "y", ["id"]).fit(past).predict(held).collect()
    assert pinball(boosted) < pinball(forest)
    assert all(r.q10 <= r.q50 <= r.q90 for r in boosted)
    high = [r.q50 for r in boosted if r.a is None]
    assert min(high) > np.mean([r.q50 for r in boosted if r.a is not None])


def jobs_of(spark, name, fn):
    spark.sparkContext.setJobGroup(name, name)
    out = fn()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), out


def test_folds_are_fitted_together_and_see_the_past_only(spark):
    df = table(spark, 400).withColumn("fold", F.floor(F.col("id") / 100).cast("int"))
    one, _ = jobs_of(spark, "one", lambda: small("fold").fit(df.where("fold <= 1")))
    many, model = jobs_of(spark, "many", lambda: small("fold").fit(df))
    assert many == one and {f for f, _ in model.models} == {1, 2, 3, ALL}
    key = lambda out: sorted((r.id, r.q10, r.q50, r.q90) for r in out.collect())
    now = key(model.predict(df, by_fold=True))
    changed = df.withColumn("y", F.when(F.col("fold") >= 2, -F.col("y")).otherwise(F.col("y")))
    then = key(small("fold").fit(changed).predict(df, by_fold=True))
    assert [r for r in now if r[0] < 300] == [r for r in then if r[0] < 300] and now != then and len(now) == 300


def test_walk_forward(spark):
    df = table(spark, 300).withColumn("ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))"))
    cutoffs = [datetime.datetime(2024, 1, day) for day in (5, 9)]
    out = walk_forward(df, cutoffs, small("passed")).collect()
    assert {r.id for r in out} == set(range(96, 300)) and all(r.cutoff == cutoffs[r.id >= 192] for r in out)


def test_boosting_of_odd_tables(spark):
    df = table(spark, 60)
    nothing = small().fit(df.limit(0))
    assert [tuple(r) for r in nothing.predict(df.limit(1)).select("q10", "q50", "q90").collect()] == [(0.0, 0.0, 0.0)]
    assert small().fit(df).predict(df.limit(0)).count() == 0
    gone = df.withColumns({"a": F.lit(None).cast("double"), "y": F.when(F.col("id") > 5, F.col("y"))})
    assert small(least=1).fit(gone).predict(gone).where("q50 is null").count() == 0


def test_stack_round_trip(spark, tmp_path):
    df = table(spark, 150).withColumn("fold", F.floor(F.col("id") / 50).cast("int"))
    stack = fit_stack(df, small("fold"), small("fold"), "c")
    stack.save(spark, f"file://{tmp_path}/s", metric_rows(df.agg(F.count("*").alias("n"), F.avg("y").alias("mean")), []))
    again = Stack(small("fold"), small("fold"), QuantileLinear(Stack.inputs("c"), "y"), "c").load(spark, f"file://{tmp_path}/s")
    one, two = (sorted(tuple(r) for r in s.predict(df).select("id", "q10", "q50", "q90").collect()) for s in (stack, again))
    assert np.allclose(one, two)
    assert {r.metric for r in spark.read.parquet(f"file://{tmp_path}/s/metrics").collect()} == {"n", "mean"}


def test_linear(spark):
    df = table(spark)
    out = QuantileLinear(["a", "b"], "y").fit(df).predict(df)
    assert np.allclose(shares(out), [0.1, 0.5, 0.9], atol=0.03) and out.where("q10 > q50 or q50 > q90").count() == 0


def test_empty_prediction(spark):
    df = table(spark, 100)
    assert QuantileForest(["a"], "y", ["id"], trees=2, depth=2).fit(df).predict(df.limit(0)).count() == 0


def test_pluggable_scorer(spark):
    out = score_with(table(spark, 10), ["id"], "id long, q10 double, q50 double, q90 double", lambda p: {"q10": p.a - 1, "q50": p.a, "q90": p.a + 1})
    assert out.count() == 10 and out.where("q90 - q10 <> 2").count() == 0
