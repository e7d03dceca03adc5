"""Queries of the silver layer: slots, fleets, grids, gap flags, clamps, dedup, issues, weighted means, fusion, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.functions import columns as fn
from sparkcast.operators import fusion, grid, quality
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS, WEIGHTS_SQL, sql
from sparkcast.plans.register import query
from sparkcast.sources import buckets, snapshots
from sparkcast.sources.scratch import scratch_path


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'view'")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type") == "view").select("event_id", "ts", "value")


@query(sql("SELECT stamp, slot, time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 30 MINUTE, TIMESTAMP '2000-01-01') AS start_slot FROM readings", "readings"))
def floor_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot of a reading, taking its time as an instant and as a period's end."""
    return feeds.readings(spark, sf_dir).select("stamp", "slot", fn.floor_slot(F.col("ts") - fn.minutes(30)).alias("start_slot"))


@query(sql("SELECT region, ts, total, n, round(total / 500000, 10) AS total_mw, round(total / greatest(n, 1), 6) AS mean_wh FROM fleet", "fleet"))
def site_to_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    mw, mean = F.round(F.col("total") / 500_000, 10), F.round(F.col("total") / F.greatest(F.col("n"), F.lit(1)), 6)
    return feeds.fleet(spark, sf_dir).withColumns({"total_mw": mw, "mean_wh": mean})


@query(sql("SELECT region, ts, total, n FROM spine", "spine"))
def canonical_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.spine(spark, sf_dir)


_GAPS = """
    , marked AS (SELECT *, total IS NULL AS missing, coalesce((total IS NULL) <> lag(total IS NULL) OVER w, false) AS change FROM {spine} WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
    runs AS (SELECT *, sum(change::INT) OVER (PARTITION BY {key} ORDER BY ts) AS run FROM marked),
    sized AS (SELECT *, count(*) OVER (PARTITION BY {key}, run) AS len FROM runs)
    SELECT {key}, ts, n, coalesce(total, lag(total) OVER (PARTITION BY {key} ORDER BY ts)) AS total,
           CASE WHEN NOT missing THEN 'ok' WHEN len <= 1 THEN 'ffill' WHEN len > 6 THEN 'long_gap' ELSE 'gap' END AS data_quality_flag FROM sized
"""


@query(sql(_GAPS.format(spine="spine", key="region"), "spine"))
def gap_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.gap_policy(feeds.spine(spark, sf_dir), KEYS, "total")


_SITES = """WITH site_slots AS (SELECT user_id AS site, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '2000-01-01') AS ts, round(sum(value), 4) AS total, count(value) AS n FROM events GROUP BY ALL),
    site_spine AS (SELECT g.site, g.ts, s.total, s.n FROM (SELECT site, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM site_slots GROUP BY site)) g
        LEFT JOIN site_slots s ON g.site = s.site AND g.ts = s.ts)"""


@query(_SITES + _GAPS.format(spine="site_spine", key="site"))
def gap_policy_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same policy for every single site, with long gaps."""
    slots = grid.site_to_fleet(feeds.readings(spark, sf_dir).drop("slot"), ["site"]).withColumn("total", F.round("total", 4))
    return grid.gap_policy(grid.canonical_grid(slots, ["site"]), ["site"], "total", parts=grid.grid_parts(slots, ["site"]))


@query(sql("SELECT stamp, CASE WHEN value BETWEEN 5 AND 150 THEN value END AS value FROM readings", "readings"))
def clamp_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clamp_range(feeds.readings(spark, sf_dir).select("stamp", "value"), {"value": (5.0, 150.0)})


@query("""SELECT event_id, CASE WHEN v < 0 OR (cap IS NOT NULL AND cap > 0 AND v > cap * 1.5) THEN NULL ELSE v END AS v
    FROM (SELECT event_id, value - 10 AS v, CASE WHEN event_id % 7 = 0 THEN NULL ELSE (user_id % 50) * 1.0 END AS cap FROM events)""")
def clamp_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = feeds.readings(spark, sf_dir).select(F.col("stamp").alias("event_id"), (F.col("value") - 10).alias("v"), F.when(F.col("stamp") % 7 != 0, F.col("site") % 50 * 1.0).alias("cap"))
    return quality.clamp_capacity(r, "v", "cap").drop("cap")


@query(sql("SELECT region, ts, issue, stamp FROM issues WHERE issue <= ts", "issues"))
def drop_leaky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_leaky(feeds.issues(spark, sf_dir), "issue", "ts").select("region", "ts", "issue", "stamp")


@query(sql("SELECT region, ts, value, stamp FROM (SELECT region, slot AS ts, CASE WHEN value <= 100 THEN value END AS value, stamp, row_number() OVER (PARTITION BY region, slot ORDER BY stamp DESC) AS k FROM readings) WHERE k = 1", "readings"))
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshest reading per slot, even if its value was clamped to NULL before."""
    r = feeds.readings(spark, sf_dir).select("region", F.col("slot").alias("ts"), "value", "stamp")
    return grid.dedup_latest(quality.clamp_range(r, {"value": (0.0, 100.0)}), ["region", "ts"], "stamp")


_LATEST = "SELECT region, ts, issue, solar, stamp FROM (SELECT *, row_number() OVER (PARTITION BY region, ts ORDER BY issue DESC NULLS LAST, stamp DESC) AS k FROM issues WHERE issue IS NULL OR issue <= ts - INTERVAL {lead} MINUTE) WHERE k = 1"


@query(sql(_LATEST.format(lead=0), "issues"))
def latest_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp")


@query(sql(_LATEST.format(lead=30), "issues"))
def latest_issue_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, one step ahead of the slot."""
    return fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp", lead=1)


_ASOF = "newest AS (SELECT region, ts, max(init) AS init, arg_max_null(ssrd, init) AS ssrd, arg_max_null(tcc, init) AS tcc FROM cube WHERE init <= ts - INTERVAL 720 MINUTE GROUP BY region, ts)"


@query(sql(f", {_ASOF} SELECT region, ts, init, ssrd, tcc FROM newest", "cube"))
def asof_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.asof_horizon(feeds.cube(spark, sf_dir), 24, KEYS)


@query(f"SELECT region, weight / sum(weight) OVER () AS weight FROM {WEIGHTS_SQL} WHERE region IN (SELECT event_type FROM events)")
def weights_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights over the regions that occur, so that they sum to 1."""
    present = feeds.readings(spark, sf_dir).select("region").distinct()
    return fusion.normalised_weights(feeds.weights(spark).join(present, "region", "left_semi"))


_WEIGHTED = f"""weighted AS (SELECT ts, init, round(CASE WHEN sum(w) > 0 AND count(ssrd) = count(*) THEN sum(ssrd * w) / sum(w) END, 9) AS ssrd,
    round(CASE WHEN sum(w) > 0 AND count(tcc) = count(*) THEN sum(tcc * w) / sum(w) END, 9) AS tcc, round(date_diff('second', init, ts) / 3600.0, 6) AS age_h
    FROM (SELECT c.*, coalesce(weight, 0) AS w FROM cube c LEFT JOIN {WEIGHTS_SQL} ON c.region = w.region) GROUP BY ts, init)"""


@query(sql(f", {_WEIGHTED} SELECT ts, init, ssrd, tcc, age_h FROM weighted", "cube"))
def nwp_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted spatial means of the forecast cube with the forecast's age; unknown regions weigh nothing."""
    cells = fusion.lookup(feeds.cube(spark, sf_dir), feeds.weights(spark), "region", "weight")
    out = fusion.weighted_mean(cells, ["ts", "init"], ["ssrd", "tcc"], "weight")
    return out.select("ts", "init", *(F.round(c, 9).alias(c) for c in ("ssrd", "tcc")), F.round(fn.hours_between("ts", "init"), 6).alias("age_h"))


_FUSED = sql(f""", {_ASOF}, last AS ({_LATEST.format(lead=0)})
    SELECT s.region, s.ts, total, ssrd, tcc, solar FROM spine s LEFT JOIN newest a ON s.region = a.region AND s.ts = a.ts LEFT JOIN last l ON s.region = l.region AND s.ts = l.ts""", "spine", "cube", "issues")


def _sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Spine, as-of weather and latest issue on one grid."""
    weather = fusion.asof_horizon(feeds.cube(spark, sf_dir), 24, KEYS).drop("init")
    last = fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp").select("region", "ts", "solar")
    return [feeds.spine(spark, sf_dir).drop("n"), weather, last]


@query(_FUSED)
def fuse_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine, *rest = _sources(spark, sf_dir)
    return fusion.fuse(spine, rest, ["region", "ts"])


@query(_FUSED)
def fuse_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from layers in buckets, which are fused without an exchange."""
    on = ["region", "ts"]
    spine, *rest = (buckets.write_layer(s, scratch_path(spark, "layer"), on, 8) for s in _sources(spark, sf_dir))
    return buckets.fuse_layers(spine, rest, on)


@query(sql("SELECT region, ts, coalesce(total, lag(total, 1) OVER w) AS total FROM spine WINDOW w AS (PARTITION BY region ORDER BY ts)", "spine"))
def ffill_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.forward_fill(feeds.spine(spark, sf_dir).drop("n"), KEYS, ["total"], 1)


@query(sql("""SELECT region, ts, coalesce(last_value(x IGNORE NULLS) OVER (PARTITION BY region ORDER BY ts ROWS UNBOUNDED PRECEDING),
    first_value(x IGNORE NULLS) OVER (PARTITION BY region ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS total
    FROM (SELECT region, ts, CASE WHEN total > 100 THEN total END AS x FROM spine)""", "spine"))
def ffill_bfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = feeds.spine(spark, sf_dir).select("region", "ts", F.when(F.col("total") > 100, F.col("total")).alias("total"))
    return grid.fill_both_ways(s, KEYS, ["total"])


@query(sql("""SELECT region, ts, total, capacity FROM capped UNION ALL
    SELECT region, unnest(generate_series(last + INTERVAL 30 MINUTE, last + INTERVAL 720 MINUTE, INTERVAL 30 MINUTE)), NULL, cap
    FROM (SELECT region, max(ts) AS last, arg_max(capacity, ts) AS cap FROM capped GROUP BY region)""", "capped"))
def extend_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve hours of future slots per region, carrying the last capacity."""
    return grid.extend_spine(feeds.capped(spark, sf_dir).drop("n"), KEYS, F.col("_last") + fn.minutes(720), ["capacity"])


@query(sql("SELECT region, count(*) AS n, date_diff('second', min(ts), max(ts)) / 1800.0 + 1 AS expected, round(count(*) / (date_diff('second', min(ts), max(ts)) / 1800.0 + 1), 9) AS coverage FROM fleet GROUP BY region", "fleet"))
def coverage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(feeds.fleet(spark, sf_dir), KEYS).withColumn("coverage", F.round("coverage", 9))


@query(sql("SELECT count(*) AS n, CASE WHEN count(*) > 100 THEN round(corr(a.total, b.total), 6) END AS corr FROM fleet a JOIN fleet b ON a.ts = b.ts AND a.region = 'view' AND b.region = 'click'", "fleet"))
def cross_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feeds.fleet(spark, sf_dir)
    a, b = (f.where(F.col("region") == r).select("ts", F.col("total").alias(r)) for r in ("view", "click"))
    return quality.cross_correlation(a, b, ["ts"], "view", "click").withColumn("corr", F.round("corr", 6))


@query(sql("SELECT round(avg((total <= 0.5 * capacity)::INT::DOUBLE), 9) AS under_half, round(avg((total < 500)::INT::DOUBLE), 9) AS below_500 FROM capped", "capped"))
def pass_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = feeds.capped(spark, sf_dir)
    out = quality.pass_fraction(c, {"under_half": F.col("total") <= 0.5 * F.col("capacity"), "below_500": F.col("total") < 500})
    return out.select(*(F.round(x, 9).alias(x) for x in out.columns))


@query(sql("""SELECT region, arg_max(step, c * 1000000000 - step) AS modal_step FROM (SELECT region, step, count(*) AS c FROM
    (SELECT region, date_diff('second', lag(ts) OVER (PARTITION BY region ORDER BY ts), ts) AS step FROM fleet) WHERE step IS NOT NULL GROUP BY ALL) GROUP BY region""", "fleet"))
def modal_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.modal_step(feeds.fleet(spark, sf_dir), KEYS)


@query(sql("""SELECT rule, n FROM (SELECT unnest(['known', 'range', 'positive', 'unique']) AS rule, unnest([a, b, c, d]) AS n FROM
    (SELECT count(*) FILTER (WHERE ts IS NULL) AS a, count(*) FILTER (WHERE NOT value BETWEEN 0 AND 150) AS b, count(*) FILTER (WHERE NOT value >= 1) AS c FROM readings),
    (SELECT count(*) AS d FROM (SELECT 1 FROM readings GROUP BY region, slot HAVING count(*) > 1)))""", "readings"))
def contracts_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = feeds.readings(spark, sf_dir)
    return quality.violations(r, {"known": F.col("ts").isNotNull(), "range": F.col("value").between(0, 150), "positive": F.col("value") >= 1}, ["region", "slot"])


@query(sql("SELECT region, ts, sum(total) AS total, CAST(sum(n) AS BIGINT) AS n FROM (SELECT region, ts, total, n FROM fleet UNION ALL SELECT region, ts, total * 2, n FROM fleet WHERE region <> 'view') GROUP BY ALL", "fleet"))
def merge_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feeds.fleet(spark, sf_dir)
    return fusion.merge_partials([f, f.where(F.col("region") != "view").withColumn("total", F.col("total") * 2)], ["region", "ts"], ["total", "n"])


_CLAMPED = """fresh AS (SELECT region, ts, CASE WHEN value BETWEEN 0 AND 300 THEN value END AS generation FROM
    (SELECT region, slot AS ts, value, row_number() OVER (PARTITION BY region, slot ORDER BY stamp DESC) AS k FROM readings) WHERE k = 1),
    fresh_spine AS (SELECT g.region, g.ts, f.generation AS total, 1 AS n FROM (SELECT region, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM (SELECT region, min(ts) AS lo, max(ts) AS hi FROM fresh GROUP BY region)) g
    LEFT JOIN fresh f ON g.region = f.region AND g.ts = f.ts)"""


@query(sql(f", {_CLAMPED} " + _GAPS.format(spine="fresh_spine", key="region").replace("SELECT region, ts, n, coalesce", "SELECT region, ts, coalesce"), "readings"))
def silver_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metered series: clamp, freshest reading per slot, grid, gap policy."""
    r = feeds.readings(spark, sf_dir).select("region", F.col("slot").alias("ts"), F.col("value").alias("total"), "stamp")
    fresh = grid.dedup_latest(quality.clamp_range(r, {"total": (0.0, 300.0)}), ["region", "ts"], "stamp").drop("stamp")
    return grid.gap_policy(grid.canonical_grid(fresh, KEYS), KEYS, "total")


@query(sql(f", {_WEIGHTED} SELECT ts, init, ssrd, tcc, age_h FROM weighted WHERE init <= ts AND age_h >= 0", "cube"))
def silver_nwp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather layer: one row per cell, no leaks, weighted means for each (valid, init)."""
    return quality.drop_leaky(nwp_weighted(spark, sf_dir), "init", "ts")


@query(sql(f""", last AS ({_LATEST.format(lead=0)}), last_spine AS (SELECT g.region, g.ts, l.solar AS total, 1 AS n FROM
    (SELECT region, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM (SELECT region, min(ts) AS lo, max(ts) AS hi FROM last GROUP BY region)) g LEFT JOIN last l ON g.region = l.region AND g.ts = l.ts)
    """ + _GAPS.format(spine="last_spine", key="region").replace("SELECT region, ts, n, coalesce", "SELECT region, ts, coalesce"), "issues"))
def silver_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issue log: newest issue per slot, grid, gap policy."""
    last = fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp").select("region", "ts", F.col("solar").alias("total"))
    return grid.gap_policy(grid.canonical_grid(last, KEYS), KEYS, "total")


@query(sql(_GAPS.format(spine="spine", key="region").replace("SELECT region, ts, n, coalesce(total", "SELECT region, ts, CAST(n AS INTEGER) AS n, round(total / 500000 / 1.0, 10) AS mw, coalesce(total"), "spine"))
def silver_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site feed: fleet sums on a grid with flags; mw is not filled."""
    s = feeds.spine(spark, sf_dir).withColumn("mw", F.round(F.col("total") / 500_000 / 1.0, 10)).withColumn("n", F.col("n").cast("int"))
    return grid.gap_policy(s, KEYS, "total")


@query("""WITH points AS (SELECT o_orderkey AS name, (o_orderkey * 7919 % 5300) / 100.0 - 10 AS px, (o_custkey * 104729 % 410) / 10.0 - 8 AS py FROM orders),
    field AS (SELECT l_partkey % 30 AS x, l_suppkey % 20 AS y, max(l_quantity) AS value FROM lineitem WHERE l_partkey % 7 <> 3 GROUP BY ALL),
    nx AS (SELECT name, arg_min(x, (abs(x - px), x)) AS x FROM (SELECT DISTINCT x FROM field), points GROUP BY name),
    ny AS (SELECT name, arg_min(y, (abs(y - py), y)) AS y FROM (SELECT DISTINCT y FROM field), points GROUP BY name)
    SELECT name, f.x, f.y, value FROM nx JOIN ny USING (name) JOIN field f ON f.x = nx.x AND f.y = ny.y""")
def nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gridded field at a point for every order."""
    items, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    field = items.where("l_partkey % 7 <> 3").groupBy((F.col("l_partkey") % 30).alias("x"), (F.col("l_suppkey") % 20).alias("y")).agg(F.max("l_quantity").alias("value"))
    px, py = F.col("o_orderkey") * 7919 % 5300 / 100.0 - 10, F.col("o_custkey") * 104729 % 410 / 10.0 - 8
    return fusion.sample_points(field, orders.select(F.col("o_orderkey").alias("name"), px.alias("px"), py.alias("py")), [])


_BOUNDS = {"value": (5.0, 150.0), "site": (10.0, 1e9)}


@query(sql("SELECT unnest(['value', 'site']) AS column, unnest([count(*) FILTER (WHERE NOT value BETWEEN 5 AND 150), count(*) FILTER (WHERE NOT site BETWEEN 10 AND 1e9)]) AS n FROM readings", "readings"))
def clamp_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values the range clamp takes away."""
    return quality.clamp_counts(feeds.readings(spark, sf_dir), _BOUNDS)


@query(sql("""SELECT rule, 'warn' AS severity, round(value, 6) AS value, least, coalesce(value >= least, true) AS holds FROM (
    SELECT 'coverage' AS rule, min(c) AS value, 0.98 AS least FROM (SELECT count(*) / (date_diff('second', min(ts), max(ts)) / 1800.0 + 1) AS c FROM fleet GROUP BY region)
    UNION ALL SELECT 'under_capacity', avg((value <= 1.05 * 100)::INT::DOUBLE), 0.95 FROM readings
    UNION ALL SELECT 'correlation', CASE WHEN count(*) > 100 THEN corr(a.total, b.total) END, 0.85 FROM fleet a JOIN fleet b ON a.ts = b.ts AND a.region = 'view' AND b.region = 'click')""", "fleet"))
def soft_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings: coverage of at least 98 %, at least 95 % of values under 1.05 times a capacity of 100, a correlation of two
    sources above 0.85."""
    f = feeds.fleet(spark, sf_dir)
    a, b = (f.where(F.col("region") == r).select("ts", F.col("total").alias(r)) for r in ("view", "click"))
    values = {
        "coverage": (quality.coverage(f, KEYS).agg(F.min("coverage").alias("v")), "v", 0.98),
        "under_capacity": (quality.pass_fraction(feeds.readings(spark, sf_dir), {"v": F.col("value") <= 1.05 * 100}), "v", 0.95),
        "correlation": (quality.cross_correlation(a, b, ["ts"], "view", "click"), "corr", 0.85),
    }
    return quality.warnings(values).withColumn("value", F.round("value", 6))


@query(sql("SELECT region, ts, value, stamp FROM (SELECT region, slot AS ts, value, stamp, row_number() OVER (PARTITION BY region, slot ORDER BY value, stamp) AS k FROM readings) WHERE k = 1", "readings"))
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest reading per slot, the older of equal ones."""
    r = feeds.readings(spark, sf_dir).select("region", F.col("slot").alias("ts"), "value", "stamp")
    return grid.dedup_first(r, ["region", "ts"], ["value", "stamp"])


@query(sql("SELECT stamp, CAST(value AS FLOAT) AS wh, CAST(NULL AS DOUBLE) AS wind, region FROM readings", "readings"))
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed, reordered, typed; a column that the source lacks is NULL."""
    return grid.align(feeds.readings(spark, sf_dir), {"stamp": "bigint", "wh": "float", "wind": "double", "region": "string"}, {"value": "wh"})


@query(sql(f", {_CLAMPED} " + _GAPS.format(spine="fresh_spine", key="region").replace("SELECT region, ts, n, coalesce", "SELECT region, ts, coalesce"), "readings"))
def publish_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metered series built, validated, written as a layer by month and read back."""
    path = scratch_path(spark, "silver")
    rules = {"known": F.col("ts").isNotNull(), "range": F.col("total").between(0, 300)}
    snapshots.publish(silver_pv(spark, sf_dir), path, rules, ["region", "ts"])
    return snapshots.read(spark, path)
