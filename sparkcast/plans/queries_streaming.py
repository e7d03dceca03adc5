"""Queries of the streaming jobs: each runs over all that is there, in several micro-batches, and reads its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.operators import features
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS, WEIGHTS_SQL, sql
from sparkcast.plans.queries_features import H, roll_sql
from sparkcast.plans.register import query
from sparkcast.sources import snapshots
from sparkcast.sources.scratch import scratch_path
from sparkcast.streaming import jobs


#: Readings that come an hour after their time.
LATE = "stamp % 7 = 3"


def _stream(spark: SparkSession, df: DataFrame, batches: int = 4, late: str = "false", very_late: str = "false") -> DataFrame:
    """df as a stream of files: each batch holds a range of arrival times in no order. A row arrives at its time `ts`, or an
    hour later where the condition `late` holds, 30 days later where `very_late` does. Bounds are computed once, so every row is written once."""
    path, files = scratch_path(spark, "stream"), max(2, spark.sparkContext.defaultParallelism)
    arrival = F.when(F.expr(very_late), F.col("ts") + F.expr("INTERVAL 30 DAY")).when(F.expr(late), F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    rows = df.withColumn("_at", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), arrival.cast("timestamp_ntz")))
    lo, hi = rows.agg(F.min("_at"), F.max("_at")).first()
    width = ((hi or 0) - (lo or 0)) // batches + 1
    for k in range(batches):  # one write a batch, so that they arrive in this order
        own = rows.where(F.floor((F.col("_at") - F.lit(lo or 0)) / width) == k)
        own.drop("_at").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.readings(spark, sf_dir).drop("slot").withColumn("ts", F.col("ts").cast("timestamp"))


@query(sql("SELECT region, ts, total, n FROM fleet, (SELECT max(ts) AS last FROM readings) m WHERE fleet.ts + INTERVAL 30 MINUTE <= m.last - INTERVAL 2 HOUR", "fleet"))
def stream_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots whose sums are final, though some readings come late."""
    path = scratch_path(spark, "fleet")
    jobs.run_available(jobs.fleet_stream(_stream(spark, _readings(spark, sf_dir), late=LATE), KEYS), path)
    out = spark.read.schema("region string, ts timestamp, total double, n long").parquet(f"{path}/data")
    return out.select("region", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("total", 4).alias("total"), "n")


@query(sql("SELECT region, ts, value, stamp FROM (SELECT region, slot AS ts, value, stamp, row_number() OVER (PARTITION BY region, slot ORDER BY stamp DESC) AS k FROM readings) WHERE k = 1", "readings"))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The freshest reading per slot, kept up to date over four batches."""
    path = scratch_path(spark, "upsert")
    rows = feeds.readings(spark, sf_dir).select("region", F.col("slot").alias("ts"), "value", "stamp")
    jobs.run_each_batch(_stream(spark, rows, 4, LATE), path, jobs.upsert_step(f"{path}/table", KEYS, "stamp"))
    return snapshots.read(spark, f"{path}/table", keys=[*KEYS, "ts"], stamp="stamp").select("region", "ts", "value", "stamp")


@query("SELECT event_id AS stamp, ts, value FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading sent twice, an hour apart."""
    path, rows = scratch_path(spark, "dedup"), _readings(spark, sf_dir)
    jobs.run_available(jobs.dedup_stream(_stream(spark, rows.withColumn("copy", F.lit(0)).union(rows.withColumn("copy", F.lit(1))), late="copy = 1"), ["stamp"]), path)
    out = spark.read.schema("stamp long, ts timestamp, value double").parquet(f"{path}/data")
    return out.select("stamp", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query(sql(f"SELECT stamp, r.region, value * coalesce(weight, 0) AS weighted FROM readings r LEFT JOIN {WEIGHTS_SQL} ON r.region = w.region", "readings"))
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with their region's weight."""
    path = scratch_path(spark, "enrich")
    stream = jobs.enrich_stream(_stream(spark, _readings(spark, sf_dir), late=LATE), feeds.weights(spark), "region")
    jobs.run_available(stream.select("stamp", "region", (F.col("value") * F.coalesce("weight", F.lit(0.0))).alias("weighted")), path)
    return spark.read.schema("stamp long, region string, weighted double").parquet(f"{path}/data")


_TAIL_LAGS = features.known_lags(H)
_TAIL_ROLLS = ["gen_roll_mean_48", "gen_roll_mean_336"]
#: Readings that come a month after their time, besides those that come an hour late.
MONTH_LATE = "stamp % 97 = 5"


@query(sql(f"""SELECT region, ts, total, {", ".join(f"round(CAST(CAST(lag(total, {k}) OVER w AS FLOAT) AS DOUBLE), 2) AS gen_lag_{k}" for k in _TAIL_LAGS)},
    {", ".join(f"round(CAST(CAST({roll_sql(n, 'total', int(n.rsplit('_', 1)[1])).removesuffix(f' AS {n}')} AS FLOAT) AS DOUBLE), 2) AS {n}" for n in _TAIL_ROLLS)},
    CAST(row_number() OVER w - 1 >= {_TAIL_LAGS[-1] + 1} AS TINYINT) AS has_full_history FROM spine WINDOW w AS (PARTITION BY region ORDER BY ts)""", "spine"))
def stream_gold_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, lags, rolling means and history flags after four batches, each of which recomputed only what it touched; some of
    its readings are a month late."""
    path = scratch_path(spark, "gold")
    step = jobs.gold_tail_step(f"{path}/readings", f"{path}/gold", KEYS, ["stamp"], H)
    rows = feeds.readings(spark, sf_dir).drop("slot")
    jobs.run_each_batch(_stream(spark, rows, 4, LATE, MONTH_LATE), path, step)
    out = snapshots.read(spark, f"{path}/gold", keys=[*KEYS, "ts"])
    lags = [f"gen_lag_{k}" for k in _TAIL_LAGS]
    return out.select("region", "ts", F.round("total", 4).alias("total"), *(F.round(F.col(c).cast("double"), 2).alias(c) for c in lags + _TAIL_ROLLS), "has_full_history")
