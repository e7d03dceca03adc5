"""Feeds derived from the test tables, as DataFrames and as SQL common table expressions of the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.functions.columns import floor_slot
from sparkcast.operators import grid
from sparkcast.operators.prefix import Running, running
from sparkcast.sources.scan import scan

KEYS = ["region"]
#: Regional weights of the stand-in feed; one region of the data is left out on purpose.
WEIGHTS = {"click": 0.20, "purchase": 0.15, "search": 0.12, "view": 0.53}

CTE: dict[str, tuple[list[str], str]] = {
    "readings": ([], "SELECT event_type AS region, user_id AS site, event_id AS stamp, ts, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '2000-01-01') AS slot, value FROM events"),
    "fleet": (["readings"], "SELECT region, slot AS ts, round(sum(value), 4) AS total, count(value) AS n FROM readings GROUP BY ALL"),
    "spine": (["fleet"], """SELECT g.region, g.ts, f.total, f.n FROM (
        SELECT region, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM (SELECT region, min(ts) AS lo, max(ts) AS hi FROM fleet GROUP BY region)) g
        LEFT JOIN fleet f ON g.region = f.region AND g.ts = f.ts"""),
    "capped": (["spine"], "SELECT region, ts, total, n, max(total) OVER (PARTITION BY region ORDER BY ts) AS capacity FROM spine"),
    "cube": (["fleet"], """SELECT region, ts, date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 3 AS INTEGER)) - to_hours(CAST(3 * k AS INTEGER)) AS init, round(total / n, 4) + k AS ssrd, round(total / 100, 4) AS tcc
        FROM fleet, (SELECT unnest([-1, 0, 1, 2, 3, 4, 5]) AS k)"""),
    "issues": (["readings"], "SELECT region, slot AS ts, CASE WHEN stamp % 11 <> 0 THEN ts - to_minutes(CAST((stamp % 5 - 1) * 15 AS INTEGER)) END AS issue, value AS solar, stamp FROM readings"),
    "forecast": (["capped"], """SELECT * FROM (SELECT region, ts, total AS y, capacity, lag(total, 48) OVER w * CASE WHEN hour(ts) = 3 THEN 1.1 ELSE 0.7 END AS q10, lag(total, 48) OVER w AS q50, lag(total, 48) OVER w * 1.3 AS q90, lag(total, 1) OVER w AS base
        FROM capped WINDOW w AS (PARTITION BY region ORDER BY ts)) WHERE q50 IS NOT NULL AND y IS NOT NULL"""),
}


def sql(body: str, *names: str) -> str:
    """body with the named expressions, and those they need, in a WITH clause before it; a body may go on with ", x AS (...)"."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in CTE[name][0]:
            add(x)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({CTE[n][1]})" for n in order) + " " + body


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = scan(spark, f"{sf_dir}/events.parquet", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(F.col("event_type").alias("region"), F.col("user_id").alias("site"), F.col("event_id").alias("stamp"), "ts", floor_slot("ts").alias("slot"), "value")


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.site_to_fleet(readings(spark, sf_dir).drop("slot"), KEYS).withColumn("total", F.round("total", 4))


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.canonical_grid(fleet(spark, sf_dir), KEYS)


def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine with a capacity: the running maximum of the series."""
    return running(spine(spark, sf_dir), KEYS, {"capacity": Running("max", F.col("total"))})


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast cube: for every slot seven init times, three hours apart, of which the first comes after the slot (a leak)."""
    f = fleet(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(-1), F.lit(5))))
    init = floor_slot("ts", 180) - F.make_dt_interval(F.lit(0), 3 * F.col("k"))
    return f.select("region", "ts", init.alias("init"), (F.round(F.col("total") / F.col("n"), 4) + F.col("k")).alias("ssrd"), F.round(F.col("total") / 100, 4).alias("tcc"))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An issue log: several issues a slot, some after it, and some whose time is unknown."""
    r = readings(spark, sf_dir)
    issue = F.when(F.col("stamp") % 11 != 0, F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), ((F.col("stamp") % 5 - 1) * 15).cast("int")))
    return r.select("region", F.col("slot").alias("ts"), issue.alias("issue"), F.col("value").alias("solar"), "stamp")


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored slots: yesterday's value as q50 with a band around it, whose lower end crosses it at three o'clock; the last value
    as the baseline."""
    w = grid.by_time(KEYS)
    before = F.lag("total", 48).over(w)
    out = capped(spark, sf_dir).select("region", "ts", F.col("total").alias("y"), "capacity", (before * F.when(F.hour("ts") == 3, 1.1).otherwise(0.7)).alias("q10"), before.alias("q50"), (before * 1.3).alias("q90"), F.lag("total", 1).over(w).alias("base"))
    return out.where("q50 is not null and y is not null")


def weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WEIGHTS.items()), "region string, weight double")


WEIGHTS_SQL = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items()) + ") w(region, weight)"
