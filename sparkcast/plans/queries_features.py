"""Queries of the gold layer: lags, rolling statistics, targets, calendar, solar geometry, sequences and gold contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.operators import features, fusion, grid, quality
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS, sql
from sparkcast.plans.queries_silver import _ASOF, _LATEST
from sparkcast.plans.register import query
from sparkcast.sources import scan, snapshots
from sparkcast.sources.scratch import scratch_path

H = 24
LAT, LON = 52.5, -1.5


def _rounded(df: DataFrame, columns: list[str], places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) + 0.0 for c in columns})


_W = "WINDOW w AS (PARTITION BY region ORDER BY ts)"


@query(sql(f"SELECT region, ts, {', '.join(f'round(CAST(CAST(lag(total, {k}) OVER w AS FLOAT) AS DOUBLE), 4) AS gen_lag_{k}' for k in features.known_lags(H))}, CAST(row_number() OVER w - 1 >= 337 AS TINYINT) AS has_full_history FROM spine {_W}", "spine"))
def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = features.add_history_flag(feeds.spine(spark, sf_dir), KEYS, H)
    out = grid.in_blocks(s, KEYS, max(features.known_lags(H)), lambda rows, keys: features.add_lags(rows, keys, {"gen": "total"}, H)).drop("total", "n")
    return _rounded(out, [f"gen_lag_{k}" for k in features.known_lags(H)])


def roll_sql(name: str, c: str, n: int, f: str = "avg") -> str:
    over = f"OVER (PARTITION BY region ORDER BY ts ROWS BETWEEN {H + n - 1} PRECEDING AND {H} PRECEDING)"
    return f"CASE WHEN count({c}) {over} >= {n // 2} THEN {f}({c}) {over} END AS {name}"


def _float2(name: str) -> str:
    return f"round(CAST(CAST({name} AS FLOAT) AS DOUBLE), 2) AS {name}"


_ROLLS = ["gen_roll_mean_48", "gen_roll_mean_336", "gen_roll_std_48"]


@query(sql(f"SELECT region, ts, {', '.join(map(_float2, _ROLLS))} FROM (SELECT region, ts, {roll_sql(_ROLLS[0], 'total', 48)}, {roll_sql(_ROLLS[1], 'total', 336)}, {roll_sql(_ROLLS[2], 'total', 48, 'stddev_samp')} FROM spine)", "spine"))
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.in_blocks(feeds.spine(spark, sf_dir), KEYS, H + 335, lambda rows, keys: features.add_rolling(rows, keys, {"gen": "total"}, H, std_of=("gen",))).drop("total", "n")
    return _rounded(out, _ROLLS, 2)


@query(sql("SELECT region, ts, total, lag(total, 48) OVER w AS lag_48, round(CASE WHEN count(total) OVER r >= 24 THEN avg(total) OVER r END, 9) AS mean_48 FROM spine WINDOW w AS (PARTITION BY region ORDER BY ts), r AS (PARTITION BY region ORDER BY ts ROWS BETWEEN 71 PRECEDING AND 24 PRECEDING)", "spine"))
def rolling_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lag and a rolling mean with each series dealt into five-day blocks with a halo."""
    blocks = grid.with_halo(feeds.spine(spark, sf_dir).drop("n"), KEYS, 5, before=71)
    w = grid.by_time([*KEYS, "block"])
    r = w.rowsBetween(-71, -24)
    mean = F.when(F.count("total").over(r) >= 24, F.avg("total").over(r))
    out = blocks.withColumns({"lag_48": F.lag("total", 48).over(w), "mean_48": F.round(mean, 9)})
    return out.where("not halo").drop("halo", "block")


_TARGETS = "SELECT region, ts, total AS target_mw, CASE WHEN total / nullif(capacity, 0) IS NOT NULL THEN least(greatest(total / nullif(capacity, 0), 0.0), 1.5) END AS target_cf FROM capped"


@query(sql(f"SELECT region, ts, target_mw, round(target_cf, 9) AS target_cf FROM ({_TARGETS})", "capped"))
def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.add_targets(feeds.capped(spark, sf_dir), "total", "capacity")
    return out.select("region", "ts", "target_mw", F.round("target_cf", 9).alias("target_cf"))


_CALENDAR = """CAST(hour(ts) AS SMALLINT) AS hour, CAST(hour(ts) * 2 + minute(ts) // 30 AS SMALLINT) AS half_hour, CAST(isodow(ts) - 1 AS SMALLINT) AS dow, CAST(month(ts) AS SMALLINT) AS month,
    CAST(dayofyear(ts) AS SMALLINT) AS doy, CAST(isodow(ts) >= 6 AS TINYINT) AS is_weekend, round(sin(2 * pi() * (hour(ts) * 2 + minute(ts) // 30) / 48.0), 9) + 0.0 AS tod_sin,
    round(cos(2 * pi() * (hour(ts) * 2 + minute(ts) // 30) / 48.0), 9) + 0.0 AS tod_cos, round(sin(2 * pi() * dayofyear(ts) / 365.25), 9) + 0.0 AS doy_sin, round(cos(2 * pi() * dayofyear(ts) / 365.25), 9) + 0.0 AS doy_cos"""
_CYCLES = ["tod_sin", "tod_cos", "doy_sin", "doy_cos"]


@query(f"SELECT event_id, {_CALENDAR} FROM events")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    return _rounded(features.add_calendar(e).drop("ts"), _CYCLES, 9)


_SOLAR = """sun AS (SELECT *, 2 * pi() / 365.0 * (dayofyear(ts) - 1 + (h - 12) / 24.0) AS g FROM (SELECT *, hour(ts) + minute(ts) / 60.0 AS h FROM {source})),
    tilt AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq,
        0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS d FROM sun),
    zenith AS (SELECT *, least(1.0, greatest(-1.0, sin(radians({lat})) * sin(d) + cos(radians({lat})) * cos(d) * cos(radians((h * 60 + eq + 4 * ({lon})) / 4 - 180)))) AS cz FROM tilt)"""
_GHI = "CASE WHEN sin(asin(cz)) > 0 THEN 1098.0 * sin(asin(cz)) * exp(-0.059 / sin(asin(cz))) ELSE 0 END"


@query(f"WITH sites AS (SELECT event_id, ts, 50 + user_id % 10 AS lat, user_id % 7 - 4 AS lon FROM events), {_SOLAR.format(source='sites', lat='lat', lon='lon')} "
       "SELECT event_id, round(degrees(asin(cz)), 6) AS solar_elevation_deg, round(greatest(cz, 0), 9) AS clearsky_cos, CAST(degrees(asin(cz)) > 0 AS TINYINT) AS is_daylight FROM zenith")
def solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sun position for readings of sites with their own coordinates."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", (50 + F.col("user_id") % 10).alias("lat"), (F.col("user_id") % 7 - 4).alias("lon"))
    out = features.add_solar(e, F.col("lat"), F.col("lon"))
    return out.select("event_id", F.round("solar_elevation_deg", 6).alias("solar_elevation_deg"), F.round("clearsky_cos", 9).alias("clearsky_cos"), "is_daylight")


@query(sql(f", {_SOLAR.format(source='spine', lat=LAT, lon=LON)} SELECT region, ts, round({_GHI}, 4) AS clearsky_ghi FROM zenith", "spine"))
def clearsky(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.add_solar(feeds.spine(spark, sf_dir), F.lit(LAT), F.lit(LON))
    return out.select("region", "ts", F.round("clearsky_ghi", 4).alias("clearsky_ghi"))


@query(sql(f", {_SOLAR.format(source='capped', lat=LAT, lon=LON)} SELECT region, ts, total FROM zenith WHERE degrees(asin(cz)) > 0", "capped"))
def daylight_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkcast.operators.scoring import daylight_only

    return daylight_only(features.add_solar(feeds.capped(spark, sf_dir), F.lit(LAT), F.lit(LON))).select("region", "ts", "total")


def build_gold(spark: SparkSession, sf_dir: str, horizon: int = H) -> DataFrame:
    """The feature table: fused feeds, targets, calendar, sun, lags and rolling means; observed columns are dropped."""
    weather = fusion.asof_horizon(feeds.cube(spark, sf_dir), horizon, KEYS).drop("init")
    last = fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp").select("region", "ts", "solar")
    g = fusion.fuse(feeds.capped(spark, sf_dir).drop("n"), [weather, last], ["region", "ts"])
    g = features.add_history_flag(features.add_targets(g, "total", "capacity"), KEYS, horizon)

    def windows(rows: DataFrame, keys: list[str]) -> DataFrame:
        rows = features.add_lags(grid.forward_fill(rows, keys, ["ssrd", "tcc"], 1), keys, {"gen": "total", "cf": "target_cf"}, horizon)
        return features.add_rolling(rows, keys, {"gen": "total", "cf": "target_cf"}, horizon, std_of=("gen",))

    g = grid.in_blocks(g, KEYS, max(*features.known_lags(horizon), horizon + 335), windows)
    g = features.add_solar(features.add_calendar(g), F.lit(LAT), F.lit(LON))
    return quality.assert_no_leakage(g.drop("total"), horizon, ["total"], features.known_lags(horizon))


_FILL = "coalesce({0}, lag({0}) OVER w) AS {0}"
_GOLD_SQL = sql(f""", {_ASOF}, last AS ({_LATEST.format(lead=0)}), t AS ({_TARGETS}),
    fused AS (SELECT t.region, t.ts, target_mw, target_cf, ssrd, tcc, solar FROM t LEFT JOIN newest a ON t.region = a.region AND t.ts = a.ts LEFT JOIN last l ON t.region = l.region AND t.ts = l.ts),
    lagged AS (SELECT region, ts, target_mw, target_cf, {_FILL.format('ssrd')}, {_FILL.format('tcc')}, solar, lag(target_mw, 24) OVER w AS gen_lag_24, lag(target_cf, 336) OVER w AS cf_lag_336, row_number() OVER w AS k,
        {roll_sql('gen_roll_mean_48', 'target_mw', 48)}, {roll_sql('cf_roll_mean_336', 'target_cf', 336)} FROM fused {_W}), {_SOLAR.format(source='lagged', lat=LAT, lon=LON)}""", "capped", "cube", "issues")


@query(_GOLD_SQL + f""" SELECT region, ts, target_mw, round(target_cf, 6) AS target_cf, round(ssrd, 4) AS ssrd, round(tcc, 4) AS tcc, solar, {_CALENDAR}, round(degrees(asin(cz)), 6) AS solar_elevation_deg,
    round(CAST(CAST(gen_lag_24 AS FLOAT) AS DOUBLE), 2) AS gen_lag_24, round(CAST(CAST(cf_lag_336 AS FLOAT) AS DOUBLE), 5) AS cf_lag_336, round(CAST(CAST(gen_roll_mean_48 AS FLOAT) AS DOUBLE), 2) AS gen_roll_mean_48,
    round(CAST(CAST(cf_roll_mean_336 AS FLOAT) AS DOUBLE), 5) AS cf_roll_mean_336, CAST(k - 1 >= 337 AS TINYINT) AS has_full_history FROM zenith""")
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = build_gold(spark, sf_dir)
    places = {"target_cf": 6, "ssrd": 4, "tcc": 4, "solar_elevation_deg": 6, "gen_lag_24": 2, "cf_lag_336": 5, "gen_roll_mean_48": 2, "cf_roll_mean_336": 5, **dict.fromkeys(_CYCLES, 9)}
    g = g.withColumns({c: F.round(F.col(c).cast("double"), n) + 0.0 for c, n in places.items()})
    return g.select("region", "ts", "target_mw", "target_cf", "ssrd", "tcc", "solar", "hour", "half_hour", "dow", "month", "doy", "is_weekend", *_CYCLES, "solar_elevation_deg", "gen_lag_24", "cf_lag_336", "gen_roll_mean_48", "cf_roll_mean_336", "has_full_history")


@query(_GOLD_SQL + " SELECT region, ts, target_mw FROM lagged WHERE k - 1 >= 337 AND target_cf IS NOT NULL AND ssrd IS NOT NULL")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.training_rows(build_gold(spark, sf_dir), "target_cf", "ssrd").select("region", "ts", "target_mw")


_DAMAGED = """damaged AS (SELECT region, ts, CASE WHEN hour(ts) = 7 THEN target_cf + 2 ELSE target_cf END AS target_cf, CASE WHEN hour(ts) = 8 THEN -target_mw ELSE target_mw END AS target_mw,
    CASE WHEN hour(ts) = 9 THEN 120 ELSE degrees(asin(cz)) END AS elevation FROM zenith WHERE NOT (day(ts) = 12 AND hour(ts) = 10)),
    rows AS (SELECT * FROM damaged UNION ALL SELECT * FROM damaged WHERE day(ts) = 13), steps AS (SELECT *, date_diff('second', lag(ts) OVER (PARTITION BY region ORDER BY ts), ts) AS step FROM rows)"""


@query(_GOLD_SQL + f""" , {_DAMAGED} SELECT unnest(['cf_range', 'target_positive', 'elevation', 'step', 'unique']) AS rule, unnest([count(*) FILTER (WHERE NOT target_cf BETWEEN 0 AND 1.5), count(*) FILTER (WHERE NOT target_mw >= 0),
    count(*) FILTER (WHERE NOT elevation BETWEEN -90 AND 90), count(*) FILTER (WHERE step <> 1800), count(*) - count(DISTINCT (region, ts))]) AS n FROM steps""")
def contracts_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold rules on a table with planted breaches of each: values out of range, a missing hour, a repeated day."""
    hour, day = F.hour("ts"), F.dayofmonth("ts")
    damage = {"target_cf": F.when(hour == 7, F.col("target_cf") + 2).otherwise(F.col("target_cf")), "target_mw": F.when(hour == 8, -F.col("target_mw")).otherwise(F.col("target_mw")), "solar_elevation_deg": F.when(hour == 9, 120.0).otherwise(F.col("solar_elevation_deg"))}
    g = build_gold(spark, sf_dir).select("region", "ts", *damage).withColumns(damage).where(~((day == 12) & (hour == 10)))
    g = g.union(g.where(day == 13))
    g = g.withColumn("step", F.timestamp_diff("SECOND", F.lag("ts").over(grid.by_time(KEYS)), F.col("ts")))
    rules = {"cf_range": F.col("target_cf").between(0, 1.5), "target_positive": F.col("target_mw") >= 0, "elevation": F.col("solar_elevation_deg").between(-90, 90), "step": F.col("step") == 1800}
    return quality.violations(g, rules, ["region", "ts"])


@query(_GOLD_SQL + " SELECT region, ts, target_mw, round(target_cf, 6) AS target_cf, round(CAST(CAST(gen_lag_24 AS FLOAT) AS DOUBLE), 2) AS gen_lag_24 FROM zenith")
def publish_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table built, validated, written under its horizon's name and read back."""
    path = scan.table_name(scratch_path(spark, "gold"), H)
    rules = {"cf_range": F.col("target_cf").between(0, 1.5), "target_positive": F.col("target_mw") >= 0, "elevation": F.col("solar_elevation_deg").between(-90, 90)}
    snapshots.publish(build_gold(spark, sf_dir), path, rules, ["region", "ts"])
    out = snapshots.read(spark, path)
    return out.select("region", "ts", "target_mw", F.round("target_cf", 6).alias("target_cf"), F.round(F.col("gen_lag_24").cast("double"), 2).alias("gen_lag_24"))


_OF = {"gen": "target_mw", "cf": "target_cf"}
_WIDE = {f"{n}_lag_{k}": f"lag({c}, {k}) OVER w" for n, c in _OF.items() for k in features.known_lags(H)}
_WIDE |= {name: roll_sql(name, _OF[name.split("_")[0]], int(name.rsplit("_", 1)[1]), "stddev_samp" if "_std_" in name else "avg").removesuffix(f" AS {name}") for name in (*_ROLLS, "cf_roll_mean_48", "cf_roll_mean_336")}
_WIDE |= {c: c for c in ("ssrd", "tcc", "solar")}
#: Features that every row has; the capacity is known from a series' first value on.
_ALWAYS = ("hour", "half_hour", "dow", "month", "doy", "is_weekend", *_CYCLES, "solar_elevation_deg", "clearsky_cos", "is_daylight", "clearsky_ghi")


@query(_GOLD_SQL + f""", wide AS (SELECT {", ".join(f"{v} AS {k}" for k, v in _WIDE.items())} FROM lagged {_W}) SELECT unnest({['capacity', *_WIDE, *_ALWAYS]}) AS feature,
    unnest([(SELECT count(capacity) FROM capped), {", ".join(f"count({k})" for k in _WIDE)}, {", ".join(["count(*)"] * len(_ALWAYS))}]) AS known FROM wide""")
def feature_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table's feature columns with their number of known values."""
    g = build_gold(spark, sf_dir)
    names = features.feature_columns(g, {"target_mw", "target_cf", "has_full_history"})
    return g.agg(*(F.count(c).alias(c) for c in names)).select(F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("known")) for c in names))))


@query(sql("SELECT CAST(h AS INTEGER) AS horizon, 0 AS breaches, n AS n_rows FROM (SELECT count(*) AS n FROM spine), (SELECT unnest([12, 24, 48]) AS h)", "spine"))
def lineage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of the anti-leakage rule in tables for three horizons, with their rows."""
    out = None
    for horizon in (12, 24, 48):
        g = build_gold(spark, sf_dir, horizon)
        n = len(quality.leaks(g.columns, horizon, ["total"], features.known_lags(horizon)))
        row = g.agg(F.count("*").alias("n_rows")).select(F.lit(horizon).alias("horizon"), F.lit(n).alias("breaches"), "n_rows")
        out = row if out is None else out.union(row)
    return out


@query(sql("""SELECT region, ts, round(CASE WHEN total IS NULL THEN 0 ELSE (total - m) / s END, 6) AS total FROM spine,
    (SELECT coalesce(avg(total), 0) AS m, coalesce(nullif(stddev_pop(total), 0), 1) AS s FROM spine)""", "spine"))
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = feeds.spine(spark, sf_dir).drop("n")
    return features.standardize(s, features.fit_standardizer(s, ["total"]), ["total"]).withColumn("total", F.round("total", 6))


@query(sql(f"SELECT region, ts, 126 AS length, round(CAST(CAST(coalesce(lag(total, 125) OVER w, 0) AS FLOAT) AS DOUBLE), 2) AS first, round(CAST(CAST(coalesce(total, 0) AS FLOAT) AS DOUBLE), 2) AS last FROM spine {_W} QUALIFY row_number() OVER w >= 126", "spine"))
def sequence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 126 rows of two features; their lengths and ends."""
    s = feeds.spine(spark, sf_dir).withColumn("total", F.coalesce("total", F.lit(0.0))).withColumn("one", F.lit(1.0))
    out = features.sequence_windows(s, KEYS, ["total", "one"], 126, contiguous_step=30)
    end = lambda k: F.round(F.get(F.element_at("sequence", k), F.lit(0)).cast("double"), 2)
    return out.select("region", "ts", F.size("sequence").alias("length"), end(1).alias("first"), end(-1).alias("last"))


@query(sql(f"""SELECT region, ts, 512 AS length, round(sum, 2) AS sum FROM (SELECT region, ts, total, row_number() OVER w AS k,
    sum(coalesce(total, 0)) OVER (PARTITION BY region ORDER BY ts ROWS BETWEEN {H + 511} PRECEDING AND {H} PRECEDING) AS sum FROM spine {_W}) WHERE k > {H + 511} AND total IS NOT NULL""", "spine"))
def history_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.history_context(feeds.spine(spark, sf_dir), KEYS, "total", 512, H)
    total = F.aggregate("context", F.lit(0.0), lambda a, x: a + x)
    return out.select("region", "ts", F.size("context").alias("length"), F.round(total, 2).alias("sum"))
