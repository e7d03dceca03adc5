"""Streaming counterparts of the hourly batch: fleet sums, upserts, dedup, enrichment and refresh of the newest features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.functions.columns import floor_slot, minutes
from sparkcast.operators import features, grid
from sparkcast.sources import snapshots


def fleet_stream(readings: DataFrame, keys: list[str], late: str = "2 hours", step: str = "30 minutes") -> DataFrame:
    """Sum and count per key and slot, emitted once no more late readings are expected."""
    slot = F.window("ts", step)
    sums = readings.withWatermark("ts", late).groupBy(*keys, slot).agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    return sums.select(*keys, F.col("window.start").alias("ts"), "total", "n")


def dedup_stream(readings: DataFrame, ids: list[str], late: str = "2 hours") -> DataFrame:
    return readings.withWatermark("ts", late).dropDuplicatesWithinWatermark(ids)


def enrich_stream(readings: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    return readings.join(dimension, on, "left")


def run_available(df: DataFrame, path: str, mode: str = "append") -> None:
    """Runs a stream over all that is there into Parquet files at path/data."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/data").awaitTermination()


def run_each_batch(df: DataFrame, path: str, step) -> None:
    """Runs a stream over all that is there, giving each micro-batch to step(batch, number)."""
    df.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def upsert_step(path: str, keys: list[str], stamp: str):
    """For each batch: lays its freshest row per key and slot over the table, and merges months that lie in many parts. Readers
    pick the freshest of a slot's rows."""

    def step(batch: DataFrame, number: int) -> None:
        snapshots.append_batch(grid.dedup_latest(batch, [*keys, "ts"], stamp), path, number)
        snapshots.compact(batch.sparkSession, path, [*keys, "ts"], stamp)
        snapshots.vacuum(batch.sparkSession, path)

    return step


def _state(spark: SparkSession, path: str, number: int, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/batch-{number}") if number >= 0 else spark.createDataFrame([], schema)


def touched_intervals(slots: DataFrame, spans: DataFrame, keys: list[str], reach: int, step: int = 30) -> DataFrame:
    """(keys, lo, hi): the slots whose features change, as intervals that neither overlap nor touch.

    slots has (keys, ts) of the changed slots, each of which bears on the `reach` slots after it. spans has (keys, was_first,
    was_last, first, last) of each key's series before and now: slots between, before or behind what was there are new.
    """
    later = lambda c, n: F.col(c) + minutes(n * step)
    known = spans.select(*keys, "first", "last", "was_first", "was_last")
    changed = slots.select(*keys, F.col("ts").alias("lo"), later("ts", reach).alias("hi"))
    before = known.where(F.col("first") < F.col("was_first")).select(*keys, F.col("first").alias("lo"), later("was_first", reach).alias("hi"))
    behind = known.where(F.col("last") > F.col("was_last")).select(*keys, later("was_last", 1).alias("lo"), F.col("last").alias("hi"))
    new = known.where(F.col("was_first").isNull()).select(*keys, F.col("first").alias("lo"), F.col("last").alias("hi"))
    parts = changed.union(before).union(behind).union(new).join(known.select(*keys, "last"), keys)
    parts = parts.select(*keys, "lo", F.least("hi", "last").alias("hi"))
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reached = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = (reached.isNull() | (F.col("lo") > reached + minutes(step))).cast("int")
    return parts.withColumn("_apart", apart).withColumn("_k", F.sum("_apart").over(w)).groupBy(*keys, "_k").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_k")


#: Slots that are computed together at most; longer intervals are cut.
PIECE = 2880


def gold_tail_step(readings_path: str, gold_path: str, keys: list[str], ids: list[str], horizon: int, sizes: tuple[int, ...] = (48, 336), step: int = 30):
    """For each batch of readings: adds them, then recomputes fleet sums, lags, rolling means and the history flag of those slots
    only whose values the batch changes, whenever they were.

    A changed slot bears on the slots up to the longest lag or rolling window after it. Such intervals are merged for each key,
    and cut into pieces; a piece needs sums of slots as far back as the windows reach, which come from the gold layer itself, so
    readings are read for changed slots only. Both layers get what is new laid over what is there. A batch that is run again,
    after any failure, gives the same layers. Readings are known by `ids` and their time; one that comes again counts with its
    last value.
    """
    lags = features.known_lags(horizon)
    reach = max(lags[-1] + 1, horizon + max(sizes) - 1)
    slot_keys = [*keys, "ts"]

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        snapshots.append_batch(grid.dedup_latest(batch.withColumn("_n", F.monotonically_increasing_id()), [*ids, "ts"], "_n").drop("_n"), readings_path, number)
        written = snapshots.snapshot(spark, gold_path)
        if number <= written.batch:
            return
        own = snapshots.read_batch(spark, readings_path, number).where(F.col("ts").isNotNull())
        slots = own.select(*keys, floor_slot("ts", step).alias("ts")).distinct()
        months = [r[0] for r in slots.select(snapshots.month_of(F.col("ts"))).distinct().collect()]  # as many as the batch touches
        now = snapshots.read(spark, readings_path, months=months, keys=[*ids, "ts"])
        now = now.withColumn("_slot", floor_slot("ts", step)).join(slots.withColumnRenamed("ts", "_slot"), [*keys, "_slot"], "left_semi").drop("_slot")
        sums = grid.site_to_fleet(now, keys, step=step).select(*slot_keys, "total", F.lit(True).alias("changed"))

        # each key's first and last slot, in a small table of its own for every batch
        spans_schema = T.StructType([*(slots.schema[k] for k in keys), T.StructField("first", slots.schema["ts"].dataType), T.StructField("last", slots.schema["ts"].dataType)])
        was = _state(spark, f"{gold_path}-spans", written.batch, spans_schema)
        span = slots.groupBy(*keys).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
        both = was.join(span, keys, "full").select(*keys, F.least("first", "lo").alias("first"), F.greatest("last", "hi").alias("last"), F.col("first").alias("was_first"), F.col("last").alias("was_last"))
        both.select(*keys, "first", "last").write.mode("overwrite").parquet(f"{gold_path}-spans/batch-{number}")
        intervals = touched_intervals(slots, both.join(span.select(*keys), keys, "left_semi"), keys, reach, step)
        pieces = intervals.withColumn("piece", F.explode(F.sequence("lo", "hi", minutes(PIECE * step))))
        pieces = pieces.select(*keys, "piece", F.least("hi", F.col("piece") + minutes((PIECE - 1) * step)).alias("hi"))
        pieces.write.mode("overwrite").parquet(f"{gold_path}-pieces/batch-{number}")

        pieces = spark.read.schema(pieces.schema).parquet(f"{gold_path}-pieces/batch-{number}")
        rows = pieces.select(*keys, "piece", F.explode(F.sequence(F.col("piece") - minutes(reach * step), F.col("hi"), minutes(step))).alias("ts"))
        if written.schema is not None:
            of = lambda c: snapshots.month_of(c)
            reached = [r[0] for r in pieces.select(F.explode(F.sequence(of(F.col("piece") - minutes(reach * step)), of(F.col("hi")))).alias("m")).distinct().collect()]
            known = snapshots.read(spark, gold_path, written, reached, slot_keys).select(*slot_keys, F.col("total").alias("was"))
            rows = rows.join(known, slot_keys, "left")
        else:
            rows = rows.withColumn("was", F.lit(None).cast("double"))
        rows = rows.join(sums, slot_keys, "left").withColumn("total", F.when(F.col("changed"), F.col("total")).otherwise(F.col("was"))).drop("was", "changed")
        spans_now = spark.read.schema(spans_schema).parquet(f"{gold_path}-spans/batch-{number}")
        rows = features.add_lags(rows, [*keys, "piece"], {"gen": "total"}, horizon)
        rows = features.add_rolling(rows, [*keys, "piece"], {"gen": "total"}, horizon, sizes=sizes, std=())
        rows = rows.where(F.col("ts") >= F.col("piece")).join(spans_now.select(*keys, "first"), keys)
        old = F.timestamp_diff("MINUTE", F.col("first"), F.col("ts")) / step >= lags[-1] + 1
        snapshots.append_batch(rows.withColumn("has_full_history", old.cast("byte")).drop("piece", "first"), gold_path, number)
        snapshots.compact(spark, gold_path, slot_keys)
        snapshots.compact(spark, readings_path, [*ids, "ts"])
        for path in (gold_path, readings_path):
            snapshots.vacuum(spark, path)

    return run
