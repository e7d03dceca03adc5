"""Golden rows of the operators' edge cases."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sparkcast.functions import columns as fn
from sparkcast.operators import features, fusion, grid, quality, scoring
from sparkcast.sources import scan

START = dt.datetime(2024, 1, 1)


def series(spark, values, key="a"):
    rows = [(key, START + dt.timedelta(minutes=30 * k), v) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")


def flags(df):
    rows = df.orderBy("ts").collect()
    return [r.v for r in rows], [r.data_quality_flag for r in rows]


N = None


@pytest.mark.parametrize(
    "values, strict, filled, marks",
    [
        ([5.0, N, 7.0], False, [5.0, 5.0, 7.0], ["ok", "ffill", "ok"]),
        ([5.0, N, N, N, 7.0], False, [5.0, 5.0, N, N, 7.0], ["ok", "gap", "gap", "gap", "ok"]),
        ([5.0, N, N, N, 7.0], True, [5.0, N, N, N, 7.0], ["ok", "gap", "gap", "gap", "ok"]),
        ([5.0] + [N] * 7 + [7.0], False, [5.0, 5.0] + [N] * 6 + [7.0], ["ok"] + ["long_gap"] * 7 + ["ok"]),
        ([N, 7.0], False, [N, 7.0], ["ffill", "ok"]),
    ],
)
def test_gap_policy(spark, values, strict, filled, marks):
    assert flags(grid.gap_policy(series(spark, values), ["k"], "v", strict=strict)) == (filled, marks)


def test_weighted_mean_nulls(spark):
    rows = [("null member", 0.2, 10.0), ("null member", 0.8, None), ("one member", 0.2, 10.0), ("no weight", 0.0, 5.0)]
    got = {r.g: r.v for r in fusion.weighted_mean(spark.createDataFrame(rows, "g string, w double, v double"), ["g"], ["v"], "w").collect()}
    assert got == {"null member": None, "one member": 10.0, "no weight": None}


def test_targets_keep_null(spark):
    rows = [(None, 5.0), (3.0, 0.0), (30.0, 10.0), (4.0, 8.0), (-1.0, 8.0)]
    got = features.add_targets(spark.createDataFrame(rows, "g double, c double"), "g", "c").collect()
    assert [r.target_cf for r in got] == [None, None, 1.5, 0.5, 0.0]


def test_freshest_null_wins(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), ("b", None, 1.0), ("b", 9, 2.0)]
    got = {r.k: r.v for r in grid.dedup_latest(spark.createDataFrame(rows, "k string, s int, v double"), ["k"], "s").collect()}
    assert got == {"a": None, "b": 1.0}


def test_asof_horizon_is_inclusive(spark):
    at = lambda h, m=0: START + dt.timedelta(hours=h, minutes=m)
    rows = [("a", at(12), at(h, m), float(h)) for h, m in ((6, 0), (9, 0), (10, 0), (10, 30))]
    got = fusion.asof_horizon(spark.createDataFrame(rows, "k string, ts timestamp_ntz, init timestamp_ntz, v double"), 4, ["k"]).collect()
    assert [(r.init, r.v) for r in got] == [(at(10), 10.0)]


def test_latest_issue_unknown_loses(spark):
    at = lambda h, m=0: START + dt.timedelta(hours=h, minutes=m)
    rows = [("a", at(12), None, 0), ("a", at(12), at(11, 30), 1), ("a", at(12), at(12), 2), ("a", at(12), at(12, 30), 3), ("b", at(12), None, 4)]
    got = fusion.latest_issue(spark.createDataFrame(rows, "k string, ts timestamp_ntz, issue timestamp_ntz, n int"), ["k"]).collect()
    assert {r.k: r.n for r in got} == {"a": 2, "b": 4}


def test_rolling_minimum(spark):
    few, enough = [1.0] * 23 + [N] * 25 + [2.0], [1.0] * 24 + [N] * 24 + [2.0]
    for values, expected in ((few, None), (enough, 1.0)):
        out = features.add_rolling(series(spark, values), ["k"], {"v": "v"}, 1, sizes=(48,))
        assert out.orderBy(F.desc("ts")).first()["v_roll_mean_48"] == expected


def test_known_lags():
    assert [features.known_lags(h) for h in (6, 24, 48, 96)] == [[6, 48, 96, 144, 336], [24, 48, 96, 144, 336], [48, 96, 144, 336], [96, 144, 336]]


def test_no_future_value_leaks(spark):
    """Changing values younger than the horizon changes no feature."""
    values, h = [float(k % 17) for k in range(120)], 24
    names = None
    seen = []
    for shift in (0.0, 1000.0):
        changed = [v + shift if k > 100 - h else v for k, v in enumerate(values)]
        out = features.add_rolling(features.add_lags(series(spark, changed), ["k"], {"g": "v"}, h), ["k"], {"g": "v"}, h)
        names = names or [c for c in out.columns if c.startswith("g_")]
        seen.append(out.orderBy("ts").collect()[100])
    assert [seen[0][c] for c in names] == [seen[1][c] for c in names]


def test_blocks_with_halo_equal_plain_windows(spark):
    df = series(spark, [float(k * k % 101) for k in range(700)])
    plain = df.withColumn("lag", F.lag("v", 48).over(grid.by_time(["k"])))
    blocks = grid.with_halo(df, ["k"], 3, before=48)
    dealt = blocks.withColumn("lag", F.lag("v", 48).over(grid.by_time(["k", "block"]))).where("not halo").select("k", "ts", "v", "lag")
    assert sorted(map(tuple, plain.collect()), key=lambda r: r[1]) == sorted(map(tuple, dealt.collect()), key=lambda r: r[1])
    assert blocks.where("not halo").select("block").distinct().count() > 1


def test_grid_has_no_gaps(spark):
    df = series(spark, [1.0, N, 2.0]).where("v is not null")
    assert [r.v for r in grid.canonical_grid(df, ["k"]).orderBy("ts").collect()] == [1.0, None, 2.0]
    assert grid.canonical_grid(df.limit(0), ["k"]).count() == 0


def test_pinball_by_hand(spark):
    df = spark.createDataFrame([(10.0, 5.0, 10.0, 15.0)], "y double, q10 double, q50 double, q90 double")
    assert scoring.score(df, []).first().mean_pinball == pytest.approx((0.5 + 0 + 0.5) / 3)


def test_contracts(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (2, None)], "k int, v double")
    rules = {"positive": F.col("v") >= 0}
    assert {r.rule: r.n for r in quality.violations(df, rules, ["k"]).collect()} == {"positive": 1, "unique": 1}
    with pytest.raises(quality.ContractError):
        quality.check(df, rules)
    assert quality.check(df, rules, warn={"positive"}) == {"positive": 1}


def test_leakage_rule():
    assert quality.leaks(["a_lag_12", "a_lag_48"], 24, ["a"], [48]) == ["a_lag_12 is younger than the horizon of 24"]
    assert quality.leaks(["a", "a_lag_48"], 24, ["a"], [24]) == ["observed column a", "lag 24 is missing"]


def test_laea_origin_and_scale(spark):
    x, y = fusion.laea(F.col("lat"), F.col("lon"), 54.9, -2.5)
    rows = spark.createDataFrame([(54.9, -2.5), (55.9, -2.5), (54.9, -1.5)], "lat double, lon double").select(x.alias("x"), y.alias("y")).collect()
    assert abs(rows[0].x) < 1e-6 and abs(rows[0].y) < 1e-6
    assert rows[1].y == pytest.approx(111_330, rel=1e-3) and rows[2].x == pytest.approx(64_140, rel=2e-3)


def test_scalar_functions(spark):
    df = spark.createDataFrame([("2024-03-04T05:47:10Z", " Ab--c 9!", "nan")], "t string, n string, x string")
    r = df.select(fn.floor_slot(fn.parse_utc("t").cast("timestamp_ntz")).alias("slot"), fn.slug("n").alias("slug"), fn.numeric("x").alias("x"), fn.parse_utc("n").alias("bad")).first()
    assert (r.slot, r.slug, r.x, r.bad) == (dt.datetime(2024, 3, 4, 5, 30), "ab_c_9", None, None)


def test_champion(spark):
    schema = "run_id string, is_champion boolean, score double"
    pick = lambda rows, **k: tuple(scoring.select_champion(spark.createDataFrame(rows, schema), **k).first())
    assert pick([("old", True, 1.0), ("new", False, 1.0)]) == ("old", False)
    assert pick([("old", True, 1.0), ("new", False, 0.9)]) == ("new", True)
    assert pick([("old", True, 1.0), ("new", False, None)], force=True) == ("new", True)
    assert pick([("old", True, None), ("new", False, 0.9)]) == ("new", True)


def test_gap_policy_over_blocks(spark):
    """Runs that cross block bounds, whole blocks without a value, and gaps at both ends."""
    values = [N] * 3 + [1.0] + [N] * 200 + [2.0, N, 3.0] + [N] * 100 + [4.0, N, N]
    df = series(spark, values)
    near = grid.with_neighbours(df, ["k"], ["v"], days=1).orderBy("ts").collect()
    known = [k for k, v in enumerate(values) if v is not None]
    at = lambda k: START + dt.timedelta(minutes=30 * k)
    for k, r in enumerate(near):
        before, after = [i for i in known if i <= k], [i for i in known if i >= k]
        assert (r._prev_v and r._prev_v.at) == (at(before[-1]) if before else None)
        assert (r._next_v and r._next_v.at) == (at(after[0]) if after else None)
        assert (r._lo, r._hi) == (at(0), at(len(values) - 1))
    filled, marks = flags(grid.gap_policy(df, ["k"], "v"))
    assert marks == ["gap"] * 3 + ["ok"] + ["long_gap"] * 200 + ["ok", "ffill", "ok"] + ["long_gap"] * 100 + ["ok", "gap", "gap"]
    assert [k for k, v in enumerate(filled) if v is not None and values[k] is None] == [k + 1 for k in known if k + 1 < len(values) and values[k + 1] is None]
    both = [r.v for r in grid.fill_both_ways(df, ["k"], ["v"]).orderBy("ts").collect()]
    assert both[:4] == [1.0] * 4 and None not in both and both[-1] == 4.0


def test_clamp_counts(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,), (-1.0,)], "v double")
    bounds, seen = {"v": (0.0, 5.0)}, Observation("clamped")
    assert [r.v for r in quality.clamp_range(df, bounds, seen).collect()] == [1.0, None, None, None] and seen.get == {"v": 2}
    assert [tuple(r) for r in quality.clamp_counts(df, bounds).collect()] == [("v", 2)]


def test_first_and_aligned(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 7.0), ("b", None, 1.0), ("b", 1, 2.0)], "k string, s int, v double")
    assert {r.k: r.v for r in grid.dedup_first(df, ["k"], ["s"]).collect()} == {"a": 7.0, "b": 1.0}
    out = grid.align(df, {"value": "float", "none": "int", "k": "string"}, {"v": "value"})
    assert out.dtypes == [("value", "float"), ("none", "int"), ("k", "string")] and out.where("none is not null").isEmpty()


def test_forward_path_bounds(spark):
    df = series(spark, [float(k % 48) for k in range(480)])
    until = lambda hours: F.lit(START + dt.timedelta(days=10, hours=hours)).cast("timestamp_ntz")
    for hours, n in ((-48, 1), (6, 13), (500, 64)):
        out = scoring.forward_path(df, ["k"], "v", until(hours)).orderBy("ts").collect()
        assert len(out) == n and out[0].q50 == 0.0 and out[-1].q10 == float((n - 1) % 48)
    assert scoring.forward_path(df.withColumn("v", F.lit(None).cast("double")), ["k"], "v", until(6)).count() == 0


def test_lean_files(spark):
    files = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    names = lambda df, **k: {r.name for r in scan.lean_files(df, **k).collect()}
    some = files("x/archive_2023.parquet", "x/Archive_2024.parquet", "x/archive_2024_b.parquet", "x/latest_2030.parquet")
    assert names(some, lean=False) == {"x/archive_2023.parquet", "x/Archive_2024.parquet", "x/archive_2024_b.parquet"}
    assert names(some) == {"x/archive_2024_b.parquet"}  # the year is read from lower-case names only
    assert names(files("a", "b")) == {"a", "b"}


def test_gap_policy_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(grid, "TASK_ROWS", 50)
    df = series(spark, [1.0, N, 3.0] * 100)
    parts = grid.grid_parts(df, ["k"])
    out = grid.gap_policy(df, ["k"], "v", parts=parts)
    assert parts == 6 and out.rdd.getNumPartitions() == 6
    assert flags(out) == flags(grid.gap_policy(df, ["k"], "v"))
