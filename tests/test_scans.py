"""Two-level scans, chunked sequences and nearest ticks against plain loops, and the plans that they have."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import features, fusion, grid, scoring
from sparkcast.operators.prefix import Running, running

START = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def series(spark, values, key="a", slots=None):
    rows = [(key, START + dt.timedelta(minutes=30 * s), v) for s, v in zip(slots or range(len(values)), values, strict=True)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double").repartition(3)


@pytest.mark.parametrize("days", [1, 3, 400])
def test_running_values(spark, days):
    rng = random.Random(days)
    values = [rng.choice([None, float(rng.randrange(50))]) for _ in range(400)]
    values[100:210] = [None] * 110  # whole blocks without a value
    kinds = {"count": lambda x: len(x) or 0, "sum": lambda x: sum(x) if x else None, "min": lambda x: min(x, default=None), "max": lambda x: max(x, default=None)}
    what = {f"{kind}_{back}": Running(kind, F.col("v"), back) for kind in [*kinds, "last"] for back in (False, True)}
    what |= {"rows": Running("count"), "all": Running("count", whole=True), "top": Running("max", F.col("v"), whole=True)}
    got = running(series(spark, values).union(series(spark, [1.0, None], "b")), ["k"], what, days).where("k = 'a'").orderBy("ts").collect()
    for i, r in enumerate(got):
        for back in (False, True):
            known = [v for v in (values[i:] if back else values[: i + 1]) if v is not None]
            assert [r[f"{kind}_{back}"] for kind in kinds] == [f(known) for f in kinds.values()]
            assert r[f"last_{back}"] == ((known[0] if back else known[-1]) if known else None)
        assert (r["rows"], r["all"], r["top"]) == (i + 1, 400, max(v for v in values if v is not None))
    assert running(series(spark, values).limit(0), ["k"], what, days).count() == 0


def test_one_series_uses_many_tasks(spark):
    """Windows over rows are dealt by block as well as by key."""
    df = series(spark, [1.0] * 10)
    both = scoring.time_folds(features.add_history_flag(df, ["k"], 24), 5, ["k"])
    lines = [x for x in plan(both).split("\n") if "Window [" in x and "_t_" not in x]
    assert lines and all("_block" in x for x in lines)


def test_features_in_blocks_equal_plain_ones(spark):
    rng = random.Random(4)
    df = series(spark, [rng.choice([None, float(rng.randrange(100))]) for _ in range(3000)])
    make = lambda rows, keys: features.add_rolling(features.add_lags(rows, keys, {"g": "v"}, 24), keys, {"g": "v"}, 24, std_of=("g",))
    plain, dealt = make(df, ["k"]), grid.in_blocks(df, ["k"], 24 + 335, make, days=5)
    rounded = lambda out: sorted([str(r.ts), *(None if x is None else round(x, 3) for x in list(r.asDict().values())[2:])] for r in out.collect())
    assert rounded(plain) == rounded(dealt)


@pytest.mark.parametrize("step", [30, None])
def test_sequences(spark, step):
    slots = [*range(40), *range(45, 60), *range(61, 63), *range(70, 140)]
    values = [float(s * s % 97) for s in slots]
    out = features.sequence_windows(series(spark, values, slots=slots), ["k"], ["v"], 16, contiguous_step=step)
    got = {(r.ts - START) // dt.timedelta(minutes=30): [x[0] for x in r.sequence] for r in out.collect()}
    want = {slots[i]: values[i - 15 : i + 1] for i in range(15, len(slots)) if step is None or slots[i] - slots[i - 15] == 15}
    assert got == want
    if step:
        assert "Window" not in plan(out) and features.sequence_windows(series(spark, [1.0] * 15), ["k"], ["v"], 16, 30).count() == 0


@pytest.mark.parametrize("stride, most", [(1, None), (7, None), (3, 5)])
def test_contexts(spark, stride, most):
    rng = random.Random(stride)
    values = [rng.choice([None, float(rng.randrange(100))]) for _ in range(200)]
    out = features.history_context(series(spark, values), ["k"], "v", 32, 6, stride, most)
    got = {(r.ts - START) // dt.timedelta(minutes=30): r.context for r in out.collect()}
    wanted = [i for i, v in enumerate(values) if v is not None and i >= 6 + 31][::stride][:most]
    assert got == {i: [v or 0.0 for v in values[i - 6 - 31 : i - 5]] for i in wanted}
    if stride == 1:
        assert "Window" not in plan(out)


def test_nearest_cells(spark):
    rng = random.Random(3)
    xs, ys = [rng.randrange(-50, 50) / 2 for _ in range(30)], [rng.randrange(40) for _ in range(9)]
    cells = [(x, y, float(k)) for k, (x, y) in enumerate({(x, y) for x in xs for y in ys if rng.random() < 0.9})]
    points = [(k, rng.choice([rng.randrange(-120, 120) / 4, 7.0]), rng.randrange(-20, 200) / 4) for k in range(500)] + [(900, None, 1.0)]
    got = fusion.sample_points(spark.createDataFrame(cells, "x double, y int, value double"), spark.createDataFrame(points, "name int, px double, py double"), [])
    value = {(x, y): v for x, y, v in cells}
    near = lambda ticks, p: min(ticks, key=lambda t: (abs(t - p), t))
    at = {k: (near({c[0] for c in cells}, px), near({c[1] for c in cells}, py)) for k, px, py in points if px is not None}
    assert {r.name: (r.x, r.y, r.value) for r in got.collect()} == {k: (*c, value[c]) for k, c in at.items() if c in value}


def test_a_million_points_without_a_cross_join(spark):
    n = 1_000_000
    field = spark.range(1000 * 50).select((F.col("id") % 1000).cast("double").alias("x"), (F.col("id") % 50).cast("int").alias("y"), F.col("id").alias("value")).dropDuplicates(["x", "y"])
    points = spark.range(n).select(F.col("id").alias("name"), (F.col("id") % 99_991 / 100.0).alias("px"), (F.col("id") * 7 % 5003 / 100.0).alias("py"))
    out = fusion.sample_points(field, points, [])
    assert "CartesianProduct" not in plan(out) and "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
    # ticks are whole numbers, so the nearest is known by rounding half down
    off = out.join(points, "name").where((F.col("x") != F.ceil(F.col("px") - 0.5)) & (F.col("px") < 999))
    assert off.count() == 0 and out.count() > n / 50
