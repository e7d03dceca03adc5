"""Snapshots of layers, and the streaming jobs that lay batches over them."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import features, grid, quality
from sparkcast.sources import snapshots
from sparkcast.streaming import jobs

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, stamp int, v double"


def rows_of(spark, rows):
    return spark.createDataFrame([(k, START + dt.timedelta(days=day), stamp, v) for k, day, stamp, v in rows], SCHEMA)


def values(df):
    return sorted(((r.ts - START).days, r.v) for r in df.collect())


def bytes_in(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_publish_keeps_the_old_version_if_a_rule_is_broken(spark, tmp_path):
    path, rules = f"file://{tmp_path}/layer", {"positive": F.col("v") >= 0}
    snapshots.publish(rows_of(spark, [("a", 0, 1, 1.0), ("a", 40, 1, 2.0)]), path, rules, ["k", "ts"])
    with pytest.raises(quality.ContractError):
        snapshots.publish(rows_of(spark, [("a", 0, 1, -1.0)]), path, rules, ["k", "ts"])
    assert values(snapshots.read(spark, path)) == [(0, 1.0), (40, 2.0)]
    assert snapshots.vacuum(spark, path) == [2] and values(snapshots.read(spark, path)) == [(0, 1.0), (40, 2.0)]


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    """Jobs that fail while they write, or between the last file and the commit; each can be run again."""
    path = f"file://{tmp_path}/layer"
    snapshots.overwrite_months(rows_of(spark, [("a", 0, 1, 1.0), ("a", 40, 1, 2.0)]), path)
    before = snapshots.snapshot(spark, path)

    @F.udf("double")
    def dies(v):
        raise RuntimeError("killed")

    with pytest.raises(Exception):  # noqa: B017
        snapshots.overwrite_months(rows_of(spark, [("a", 0, 1, 5.0)]).withColumn("v", dies("v")), path)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            snapshots.publish(rows_of(spark, [("a", 0, 1, 6.0)]), path, {"positive": F.col("v") >= 0}, ["k", "ts"])
    assert snapshots.snapshot(spark, path) == before and values(snapshots.read(spark, path)) == [(0, 1.0), (40, 2.0)]
    snapshots.overwrite_months(rows_of(spark, [("a", 1, 1, 7.0)]), path)
    assert values(snapshots.read(spark, path)) == [(1, 7.0), (40, 2.0)]
    assert values(snapshots.read(spark, path, before)) == [(0, 1.0), (40, 2.0)]  # a reader bound to its version
    assert snapshots.vacuum(spark, path, keep=1) == [2] and values(snapshots.read(spark, path)) == [(1, 7.0), (40, 2.0)]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = f"file://{tmp_path}/layer"
    snapshots.overwrite_months(rows_of(spark, [("a", 0, 1, 1.0)]), path)
    late = snapshots.Snapshot(1, (), -1, snapshots.snapshot(spark, path).schema)
    with pytest.raises(FileExistsError):
        snapshots._commit(spark, path, late)
    with pytest.raises(ValueError):
        snapshots.overwrite_months(rows_of(spark, [("a", 0, 1, 1.0)]).drop("v"), path)
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, f"{path}-none")


def test_batches_over_batches(spark, tmp_path):
    """The freshest row of a slot counts, in whatever part it is; a batch that comes again adds nothing; months are pruned."""
    path, step = f"file://{tmp_path}/layer", None
    rng, freshest = random.Random(1), {}
    step = jobs.upsert_step(path, ["k"], "stamp")
    for number in range(12):
        batch = [("a", rng.randrange(90), number * 50 + k, float(rng.randrange(1000))) for k in range(20)]
        if number % 4 == 3:
            batch = [(k, day, stamp - 170, v) for k, day, stamp, v in batch]  # older than what is there
        for _ in range(2):
            step(rows_of(spark, batch), number)
        for _, day, stamp, v in batch:
            freshest[day] = max(freshest.get(day, (-1000, 0)), (stamp, v))
    read = snapshots.read(spark, path, keys=["k", "ts"], stamp="stamp")
    assert values(read) == sorted((day, v) for day, (_, v) in freshest.items())
    at = snapshots.snapshot(spark, path)
    assert at.batch == 11 and max(map(len, at.holders().values())) <= 5
    january = snapshots.read(spark, path, months=[2024 * 12], keys=["k", "ts"], stamp="stamp")
    assert values(january) == [x for x in values(read) if x[0] < 31]
    assert all("p_month=1/" in f for f in january.inputFiles())


def test_what_a_batch_writes_follows_the_batch(spark, tmp_path):
    path = f"file://{tmp_path}/layer"
    step = jobs.upsert_step(path, ["k"], "stamp")
    big = spark.range(200_000).select(F.lit("a").alias("k"), (F.lit(START).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id * 10)")).alias("ts"), F.lit(0).alias("stamp"), F.rand(3).alias("v"))
    step(big, 0)
    first = bytes_in(tmp_path)
    step(rows_of(spark, [("a", 3, 1, 5.0)]), 1)
    assert bytes_in(tmp_path) - first < first / 100
    assert snapshots.read(spark, path, keys=["k", "ts"], stamp="stamp").count() == 200_000


def table_of(spark, readings, keys):
    """The gold table by the batch operators."""
    slots = grid.canonical_grid(grid.site_to_fleet(readings, keys), keys)
    out = features.add_history_flag(features.add_rolling(features.add_lags(slots, keys, {"gen": "total"}, 24), keys, {"gen": "total"}, 24, std=()), keys, 24)
    return out.drop("n")


def test_gold_tail_recomputes_what_a_batch_touches_and_no_more(spark, tmp_path):
    """Two series of a year; then a few late readings, one of them before the first slot and one long after the last."""
    path = f"file://{tmp_path}"
    rng = random.Random(2)
    schema, at = "k string, id int, ts timestamp_ntz, value double", lambda slot, m=0: START + dt.timedelta(minutes=30 * slot + m)
    first = [(k, n, at(slot, 7), float(rng.randrange(100))) for k in "ab" for n, slot in enumerate(sorted(rng.sample(range(17_000), 3000)))]
    late = [("a", 5001, at(4000, 3), 9.0), ("a", 5002, at(4010), 11.0), ("b", 5003, at(-30), 2.0), ("b", 5004, at(18_000), None)]
    again = [(*late[0][:3], 10.0)]
    step = jobs.gold_tail_step(f"{path}/readings", f"{path}/gold", ["k"], ["k", "id"], 24)
    seen, columns = [], ["k", "ts", "total", "gen_lag_24", "gen_lag_48", "gen_lag_96", "gen_lag_144", "gen_lag_336", "gen_roll_mean_48", "gen_roll_mean_336", "has_full_history"]
    for number, batch in enumerate((first, late, again)):
        for _ in range(1 + (number == 1)):
            step(spark.createDataFrame(batch, schema), number)
        seen = [r for r in seen if r[:3] not in {b[:3] for b in batch}] + batch
        got = snapshots.read(spark, f"{path}/gold", keys=["k", "ts"]).select(columns)
        want = table_of(spark, spark.createDataFrame(seen, schema), ["k"]).select(columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    pieces = spark.read.parquet(f"{path}/gold-pieces/batch-1").orderBy("k", "piece").collect()
    slots = [(r.k, (r.piece - START) // dt.timedelta(minutes=30), (r.hi - START) // dt.timedelta(minutes=30)) for r in pieces]
    reach = 24 + 335
    last = max(r[2] for r in first if r[0] == "b") - START
    head = min(r[2] for r in first if r[0] == "b") - START
    last, head = (x // dt.timedelta(minutes=30) for x in (last, head))
    assert slots == [("a", 4000, 4010 + reach), ("b", -30, head + reach), ("b", last + 1, 18_000)]
    assert spark.read.parquet(f"{path}/gold-pieces/batch-2").count() == 1
    assert snapshots.read_batch(spark, f"{path}/gold", 2).count() == reach + 1
