"""Documents in pieces, and layers in buckets."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import fusion
from sparkcast.sources import buckets, sinks

def head():
    return {"model": F.lit('a "model"'), "horizon_h": F.lit(24)}


def slots(spark, n, keys=("a", "b")):
    df = spark.range(n).select(F.explode(F.lit(list(keys))).alias("k"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (30 * F.col("id")).cast("int"))).alias("ts"), "id")
    return df.select("k", "ts", F.when(F.col("id") % 5 != 0, F.col("id") + 0.12351).alias("v"), F.col("id").alias("place"))


def documents(pieces):
    out = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.k or "", r.array, r.piece)):
        out[r.k] = out.get(r.k, "") + r.text + "\n"
    return {k: json.loads(d) for k, d in out.items()}


@pytest.mark.parametrize("n, rows", [(1, 10), (10, 10), (11, 10), (200, 7)])
def test_pieces_make_documents(spark, n, rows):
    got = documents(sinks.to_forecast_json(slots(spark, n), ["k"], ["v", "place"], head(), rows=rows))
    want = [(k, None if k % 5 == 0 else round(k + 0.12351, 4), float(k)) for k in range(n)]
    assert set(got) == {"a", "b"}
    for d in got.values():
        assert list(d) == ["model", "horizon_h", "n_points", "forecast"] and d["model"] == 'a "model"' and d["n_points"] == n
        assert [(round(k), r["v"], r["place"]) for k, r in enumerate(d["forecast"])] == want
        assert d["forecast"][0]["timestamp_utc"] == "2024-01-01T00:00:00Z"
    got = documents(sinks.to_columnar_json(slots(spark, n), ["k"], {"v": F.bround("v").cast("long"), "place": F.col("place")}, rows=rows))
    for d in got.values():
        assert d["start"] == "2024-01-01T00:00:00Z" and d["step_min"] == 30 and d["n"] == n
        assert d["place"] == list(range(n)) and d["v"] == [None if k % 5 == 0 else k for k in range(n)]


def test_pieces_of_odd_tables(spark):
    df = slots(spark, 3)
    assert sinks.to_forecast_json(df.limit(0), ["k"], ["v"], head()).count() == 0
    odd = df.select(F.lit(None).cast("string").alias("k"), F.when(F.col("place") > 0, F.col("ts")).alias("ts"), F.lit(']} ,"[{').alias("v"), F.col("place").alias("text"), F.lit(1).alias("_at")).limit(3)
    (doc,) = documents(sinks.to_columnar_json(odd, ["k"], {"v": F.col("v"), "text": F.col("text")}, rows=2)).values()
    assert doc["v"] == [']} ,"[{'] * 3 and doc["n"] == 3 and len(doc["text"]) == 3


def test_numbers_are_rounded_half_to_even(spark):
    df = slots(spark, 1, ["a"]).withColumn("v", F.lit(1.12345))
    assert documents(sinks.to_forecast_json(df, ["k"], ["v"], head()))["a"]["forecast"][0]["v"] == 1.1234


def test_one_long_series_has_no_large_row_and_files_in_order(spark, tmp_path):
    pieces = sinks.to_forecast_json(slots(spark, 300_000, ["a", ""]), ["k"], ["v", "place"], head())
    path = str(tmp_path / "out")
    sinks.write_documents(pieces, ["k"], path)
    assert pieces.agg(F.max(F.length("text"))).first()[0] < 3_000_000
    for folder in ("k=a", f"k={sinks.NO_KEY}"):
        names = sorted(f for f in os.listdir(f"{path}/{folder}") if f.endswith(".txt"))
        doc = json.loads("".join(open(f"{path}/{folder}/{f}").read() for f in names))
        assert doc["n_points"] == 300_000 and [r["place"] for r in doc["forecast"]] == [float(k) for k in range(300_000)]


def test_buckets_are_fused_without_exchange(spark, tmp_path):
    spine = slots(spark, 500).select("k", "ts", "v")
    first = slots(spark, 900, ["a"]).where("place % 3 = 0").select("k", "ts", F.col("place").alias("x"))
    other = slots(spark, 50).select("k", "ts", F.lit("o").alias("y")).union(spark.createDataFrame([(None, None, "n")], "k string, ts timestamp_ntz, y string"))
    on = ["k", "ts"]
    layers = [buckets.write_layer(d, str(tmp_path / f"layer{i}"), on, 4) for i, d in enumerate((spine, first, other))]
    fused = buckets.fuse_layers(layers[0], layers[1:], on)
    want = sorted(map(str, fusion.fuse(spine, [first, other], on).collect()))
    assert sorted(map(str, fused.collect())) == want
    assert "Exchange" not in fused._jdf.queryExecution().executedPlan().toString()
    assert all(len([f for f in os.listdir(tmp_path / f"layer{i}") if f.endswith(".parquet")]) <= 4 for i in range(3))
    again = [buckets.open_layer(spark, str(tmp_path / f"layer{i}"), d.schema, on, 4) for i, d in enumerate((spine, first, other))]
    fused = buckets.fuse_layers(again[0], again[1:], on)
    assert sorted(map(str, fused.collect())) == want
    assert "Exchange" not in fused._jdf.queryExecution().executedPlan().toString()
