"""Queries of scoring and serving: metrics, splits, folds, champion, slices, lookups, quantile repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.operators import features, models, scoring
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS, sql
from sparkcast.plans.queries_features import LAT, LON, _SOLAR
from sparkcast.plans.register import query
from sparkcast.sources.scratch import scratch_path

_NOW = "TIMESTAMP '2024-01-25 00:00:00'"


def _now():
    return F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")


def _pin(q: str, level: float) -> str:
    return f"avg(greatest({level} * (y - {q}), ({level} - 1) * (y - {q})))"


_PINS = {q: _pin(q, v) for q, v in scoring.QUANTILES.items()}
_MEAN = "(" + " + ".join(_PINS.values()) + ") / 3"
_COVER = "avg((y BETWEEN q10 AND q90)::INT::DOUBLE)"
_CROSS = "avg(((q50 - q10) < -1e-9 OR (q90 - q50) < -1e-9)::INT::DOUBLE)"
_PAIR = "y IS NOT NULL AND q50 IS NOT NULL AND base IS NOT NULL"
_SKILL = f"1 - avg(abs(y - q50)) FILTER (WHERE {_PAIR}) / nullif(avg(abs(y - base)) FILTER (WHERE {_PAIR}), 0)"


def _scores(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    out = scoring.score(df, by, base="base")
    return out.select(*by, *(F.round(c, 6).alias(c) if c not in ("n", "n_pairs") else F.col(c) for c in columns))


@query(sql("SELECT region, " + ", ".join(f"round({v}, 6) AS pinball_{q}" for q, v in _PINS.items()) + f", round({_MEAN}, 6) AS mean_pinball FROM forecast GROUP BY region", "forecast"))
def pinball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(feeds.forecast(spark, sf_dir), KEYS, ["pinball_q10", "pinball_q50", "pinball_q90", "mean_pinball"])


@query(sql(f"SELECT region, round({_COVER}, 6) AS coverage, round({_CROSS}, 6) AS crossing_rate FROM forecast GROUP BY region", "forecast"))
def interval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(feeds.forecast(spark, sf_dir), KEYS, ["coverage", "crossing_rate"])


@query(sql(f"SELECT region, count(*) FILTER (WHERE {_PAIR}) AS n_pairs, round({_SKILL}, 6) AS skill FROM forecast GROUP BY region", "forecast"))
def skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(feeds.forecast(spark, sf_dir), KEYS, ["n_pairs", "skill"])


_SPLIT = "SELECT *, CASE WHEN ts >= last - INTERVAL 7 DAY THEN 'test' WHEN ts >= last - INTERVAL 14 DAY THEN 'val' ELSE 'train' END AS split FROM {0}, (SELECT max(ts) AS last FROM {0})"


@query(sql(f"SELECT split, region, 'seasonal' AS model, 24 AS horizon, count(*) AS n, round({_MEAN}, 6) AS mean_pinball, round({_COVER}, 6) AS coverage, round({_CROSS}, 6) AS crossing_rate, round({_SKILL}, 6) AS skill FROM ({_SPLIT.format('forecast')}) GROUP BY split, region", "forecast"))
def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per split, series, model and horizon."""
    df = scoring.add_split(feeds.forecast(spark, sf_dir), test_weeks=1, val_weeks=1).withColumns({"model": F.lit("seasonal"), "horizon": F.lit(24)})
    return _scores(df, ["split", "region", "model", "horizon"], ["n", "mean_pinball", "coverage", "crossing_rate", "skill"])


@query(sql("SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS quantile, unnest([round(avg((y <= q10)::INT::DOUBLE), 6), round(avg((y <= q50)::INT::DOUBLE), 6), round(avg((y <= q90)::INT::DOUBLE), 6)]) AS empirical FROM forecast", "forecast"))
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.calibration(feeds.forecast(spark, sf_dir)).withColumn("empirical", F.round("empirical", 6))


@query(sql("SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(abs(y - q50)), 6) AS mae, count(*) AS n FROM forecast GROUP BY 1", "forecast"))
def mae_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.mae_by_hour(feeds.forecast(spark, sf_dir)).withColumn("mae", F.round("mae", 6))


@query(sql(f", {_SOLAR.format(source='spine', lat=LAT, lon=LON)} SELECT split, count(*) AS n, count(*) FILTER (WHERE degrees(asin(cz)) > 0) AS n_daylight FROM ({_SPLIT.format('zenith')}) GROUP BY split", "spine"))
def split_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scoring.add_split(features.add_solar(feeds.spine(spark, sf_dir), F.lit(LAT), F.lit(LON)), test_weeks=1, val_weeks=1)
    return s.groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("is_daylight") == 1).alias("n_daylight"))


@query(sql("""SELECT region, ts, CAST(CASE WHEN b > 0 AND k >= n - 5 * b THEN floor((k - (n - 5 * b)) / b) + 1 ELSE 0 END AS INTEGER) AS fold FROM
    (SELECT region, ts, row_number() OVER (PARTITION BY region ORDER BY ts) - 1 AS k, count(*) OVER (PARTITION BY region) AS n, floor(count(*) OVER (PARTITION BY region) / 6) AS b FROM spine)""", "spine"))
def time_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.time_folds(feeds.spine(spark, sf_dir).select("region", "ts"), 5, KEYS)


@query(sql("SELECT region, ts, a[1] AS q10, a[2] AS q50, a[3] AS q90 FROM (SELECT region, ts, list_sort([q90, q50, base]) AS a FROM forecast WHERE base IS NOT NULL)", "forecast"))
def monotone_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossing quantiles repaired."""
    f = feeds.forecast(spark, sf_dir).where("base is not null").select("region", "ts", F.col("q90").alias("q10"), "q50", F.col("base").alias("q90"))
    return scoring.monotone(f, ["q10", "q50", "q90"])


@query(sql("SELECT region, ts, round(q10 * capacity, 6) AS q10, round(q50 * capacity, 6) AS q50, round(base / greatest(capacity, 1e-6), 9) AS base_cf FROM forecast", "forecast"))
def scale_to_mw(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = scoring.to_power(feeds.forecast(spark, sf_dir), ["q10", "q50"], "capacity")
    return f.select("region", "ts", F.round("q10", 6).alias("q10"), F.round("q50", 6).alias("q50"), F.round(scoring.capacity_share(F.col("base"), F.col("capacity")), 9).alias("base_cf"))


@query(sql(f", {_SOLAR.format(source='forecast', lat=LAT, lon=LON)} SELECT region, ts, CASE WHEN degrees(asin(cz)) > 0 THEN q50 ELSE 0 END AS q50, CASE WHEN degrees(asin(cz)) > 0 THEN CASE WHEN base IS NOT NULL THEN greatest(base - 50, 0) END ELSE 0 END AS base FROM zenith", "forecast"))
def night_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights are 0; the history-only baseline is also floored at 0."""
    f = features.add_solar(feeds.forecast(spark, sf_dir), F.lit(LAT), F.lit(LON)).withColumn("base", F.col("base") - 50)
    return scoring.night_zero(scoring.night_zero(f, ["q50"]), ["base"], floor=True).select("region", "ts", "q50", "base")


@query(sql("SELECT region, max(ts) FILTER (WHERE total IS NOT NULL) AS origin, arg_max(capacity, ts) AS capacity FROM capped GROUP BY region", "capped"))
def forecast_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.forecast_origin(feeds.capped(spark, sf_dir), KEYS, "total", "capacity")


_CONTEXT = """context AS (SELECT f.region, f.ts, f.q10, f.q50, f.q90, c.ssrd, c.tcc, i.solar AS issued, s.total AS actual, coalesce(s.capacity, 0) AS capacity FROM forecast f
    LEFT JOIN (SELECT region, ts, arg_max_null(ssrd, init) AS ssrd, arg_max_null(tcc, init) AS tcc FROM cube WHERE init <= ts - INTERVAL 720 MINUTE GROUP BY region, ts) c ON f.region = c.region AND f.ts = c.ts
    LEFT JOIN (SELECT region, ts, solar FROM (SELECT *, row_number() OVER (PARTITION BY region, ts ORDER BY issue DESC NULLS LAST, stamp DESC) AS k FROM issues WHERE issue IS NULL OR issue <= ts) WHERE k = 1) i ON f.region = i.region AND f.ts = i.ts
    LEFT JOIN capped s ON f.region = s.region AND f.ts = s.ts)"""


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkcast.operators import fusion

    on = ["region", "ts"]
    weather = fusion.asof_horizon(feeds.cube(spark, sf_dir), 24, KEYS).drop("init")
    last = fusion.latest_issue(feeds.issues(spark, sf_dir), KEYS, tie="stamp").select(*on, F.col("solar").alias("issued"))
    actual = feeds.capped(spark, sf_dir).select(*on, F.col("total").alias("actual"), "capacity")
    out = fusion.fuse(feeds.forecast(spark, sf_dir).select(*on, "q10", "q50", "q90"), [weather, last, actual], on)
    return out.withColumn("capacity", F.coalesce("capacity", F.lit(0.0)))


_CONTEXT_COLUMNS = "region, ts, round(q10, 4) AS q10, q50, round(q90, 4) AS q90, ssrd, tcc, issued, actual, capacity"


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("q10", "q90")}).select("region", "ts", "q10", "q50", "q90", "ssrd", "tcc", "issued", "actual", "capacity")


@query(sql(f", {_CONTEXT} SELECT {_CONTEXT_COLUMNS} FROM context", "forecast", "cube", "issues", "capped"))
def forecast_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with weather, the operator's forecast, the actual value and a capacity."""
    return _shown(_context(spark, sf_dir))


@query(sql(f", {_CONTEXT} SELECT {_CONTEXT_COLUMNS} FROM context WHERE ts >= {_NOW}", "forecast", "cube", "issues", "capped"))
def live_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(scoring.live_slice(_context(spark, sf_dir), _now()))


@query(sql(f", {_CONTEXT} SELECT region, count(*) AS n_points, count(actual) AS n_actual FROM context WHERE ts < {_NOW} AND ts >= {_NOW} - INTERVAL 14 DAY GROUP BY region", "forecast", "cube", "issues", "capped"))
def recent_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 14 days: points and how many have an actual value."""
    past = scoring.recent_slice(_context(spark, sf_dir), _now())
    return past.groupBy("region").agg(F.count("*").alias("n_points"), F.count("actual").alias("n_actual"))


_PUBLISHED = """published AS (SELECT CASE WHEN stamp % 6 = 0 THEN 'stack' ELSE 'default' END AS model, CASE WHEN stamp % 2 = 0 THEN 24 ELSE 12 END AS horizon, slot AS published, region, stamp, value AS q50 FROM readings)"""


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = feeds.readings(spark, sf_dir)
    return r.select(F.when(F.col("stamp") % 6 == 0, "stack").otherwise("default").alias("model"), F.when(F.col("stamp") % 2 == 0, 24).otherwise(12).alias("horizon"), F.col("slot").alias("published"), "region", "stamp", F.col("value").alias("q50"))


@query(sql(f""", {_PUBLISHED}, own AS (SELECT * FROM published WHERE horizon = 24 AND model = 'stack'), other AS (SELECT * FROM published WHERE horizon = 12 AND model = 'default')
    SELECT * FROM own WHERE published = (SELECT max(published) FROM own) UNION ALL SELECT * FROM other WHERE published = (SELECT max(published) FROM other)""", "readings"))
def forecast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest forecast at 24 steps, and at 12, where only the fallback model has published."""
    p = _published(spark, sf_dir)
    return scoring.forecast_lookup(p, "stack", 24).union(scoring.forecast_lookup(p, "stack", 12))


@query(sql(f", {_PUBLISHED} SELECT DISTINCT model, horizon FROM published", "readings"))
def published_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has been published."""
    return _published(spark, sf_dir).select("model", "horizon").distinct()


_RUNS = f"runs AS (SELECT region AS run_id, region = 'view' AS is_champion, CASE WHEN region = 'click' THEN NULL ELSE {_MEAN} END AS score FROM forecast GROUP BY region)"


@query(sql(f""", {_RUNS}, s AS (SELECT run_id, is_champion, coalesce(score, 'infinity'::DOUBLE) AS s FROM runs), own AS (SELECT run_id, s FROM s WHERE is_champion ORDER BY s, run_id LIMIT 1), new AS (SELECT run_id, s FROM s WHERE NOT is_champion ORDER BY s, run_id LIMIT 1)
    SELECT CASE WHEN new.s < own.s THEN new.run_id ELSE own.run_id END AS run_id, new.s < own.s AS promoted FROM own, new""", "forecast"))
def champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's forecast as a run; one of them is the incumbent, one has no score."""
    runs = scoring.score(feeds.forecast(spark, sf_dir), KEYS)
    value = F.when(F.col("region") != "click", F.col("mean_pinball"))
    return scoring.select_champion(runs.select(F.col("region").alias("run_id"), (F.col("region") == "view").alias("is_champion"), value.alias("score")))


_PAST = "list_sort(list_filter([" + ", ".join(f"lag(total, {48 * k}) OVER w" for k in range(1, 11)) + "], lambda x: x IS NOT NULL))"


@query(sql(f"SELECT region, ts, round(list_aggregate(p, 'quantile_cont', 0.1), 4) AS q10, round(list_aggregate(p, 'quantile_cont', 0.5), 4) AS q50, round(list_aggregate(p, 'quantile_cont', 0.9), 4) AS q90 FROM (SELECT region, ts, {_PAST} AS p FROM spine WINDOW w AS (PARTITION BY region ORDER BY ts)) WHERE len(p) > 0", "spine"))
def seasonal_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scoring.seasonal_quantiles(feeds.spine(spark, sf_dir), KEYS, "total", 24)
    return out.select("region", "ts", *(F.round(q, 4).alias(q) for q in scoring.QUANTILES))


# the path of each region as it was known at _NOW: slots from then on have no observation
_KNOWN = f"known AS (SELECT region, ts, CASE WHEN ts < {_NOW} THEN total / nullif(capacity, 0) END AS cf, CASE WHEN ts < {_NOW} + INTERVAL 3 HOUR THEN capacity END AS capacity, CASE WHEN ts < {_NOW} + INTERVAL 9 HOUR THEN CAST(hour(ts) BETWEEN 6 AND 18 AS INTEGER) END AS day FROM capped)"
_PATH = f"""{_KNOWN}, origins AS (SELECT region, max(ts) FILTER (WHERE cf IS NOT NULL) AS origin FROM known GROUP BY region),
    future AS (SELECT region, origin, unnest(generate_series(origin + INTERVAL 30 MINUTE, origin + to_minutes(CAST(30 * greatest(1, least(64, date_diff('minute', origin, {_NOW} + INTERVAL 24 HOUR) // 30)) AS INTEGER)), INTERVAL 30 MINUTE)) AS ts FROM origins),
    path AS (SELECT f.region, f.origin, f.ts, quantile_cont(k.cf, 0.1) AS q10, quantile_cont(k.cf, 0.5) AS q50, quantile_cont(k.cf, 0.9) AS q90 FROM future f
        LEFT JOIN known k ON k.region = f.region AND k.cf IS NOT NULL AND k.ts <= f.origin AND k.ts > f.origin - INTERVAL 10 DAY AND k.ts::TIME = f.ts::TIME GROUP BY f.region, f.origin, f.ts)"""


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, later = feeds.capped(spark, sf_dir), lambda hours: F.col("ts") < _now() + F.make_dt_interval(F.lit(0), F.lit(hours))
    cf = F.when(later(0), F.col("total") / F.nullif("capacity", F.lit(0.0)))
    return c.select("region", "ts", cf.alias("cf"), F.when(later(3), F.col("capacity")).alias("capacity"), F.when(later(9), F.hour("ts").between(6, 18).cast("int")).alias("day"))


@query(sql(f", {_PATH} SELECT region, origin, ts, round(q10, 6) AS q10, round(q50, 6) AS q50, round(q90, 6) AS q90 FROM path", "capped"))
def forward_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history-only forecast of each region's capacity factor from its last observed slot on."""
    out = scoring.forward_path(_known(spark, sf_dir), KEYS, "cf", _now() + F.make_dt_interval(F.lit(0), F.lit(24)))
    return out.select("region", "origin", "ts", *(F.round(q, 6).alias(q) for q in scoring.QUANTILES))


_SERVED = "CASE WHEN {0} IS NOT NULL THEN CASE WHEN coalesce(k.day = 1, true) THEN greatest({0}, 0) * coalesce(k.capacity, l.capacity) ELSE 0 END END"


@query(sql(f", {_PATH}, l AS (SELECT region, arg_max(capacity, ts) AS capacity FROM known GROUP BY region) SELECT p.region, p.ts, coalesce(k.capacity, l.capacity) AS capacity, "
           + ", ".join(f"round({_SERVED.format(q)}, 4) AS {q}" for q in scoring.QUANTILES)
           + " FROM path p LEFT JOIN known k ON k.region = p.region AND k.ts = p.ts LEFT JOIN l ON l.region = p.region", "capped"))
def serve_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in power: the capacity at the target time or else the last known one; unknown daylight counts as day."""
    known = _known(spark, sf_dir)
    path = scoring.forward_path(known, KEYS, "cf", _now() + F.make_dt_interval(F.lit(0), F.lit(24)))
    return scoring.serve(path, known, KEYS, "capacity", "day").select("region", "ts", "capacity", *(F.round(q, 4).alias(q) for q in scoring.QUANTILES))


@query(sql(f"SELECT region, ts, split, y AS y_true, round(q10, 4) AS q10, q50, round(q90, 4) AS q90, capacity, base, 'target_mw' AS target FROM ({_SPLIT.format('forecast')})", "forecast"))
def scored_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored slots of each split, saved and read back."""
    path = scratch_path(spark, "scored")
    df = scoring.add_split(feeds.forecast(spark, sf_dir), test_weeks=1, val_weeks=1).withColumnRenamed("y", "y_true")
    models.save_scored(df, path, ["region", "ts", "split", "y_true", "q10", "q50", "q90", "capacity", "base"], "target_mw")
    return spark.read.parquet(path).withColumns({q: F.round(q, 4) for q in ("q10", "q90")})


@query(sql(f"SELECT split, unnest(['n', 'mean_pinball', 'coverage', 'skill']) AS metric, unnest([n, p, c, s]) AS value FROM (SELECT split, count(*)::DOUBLE AS n, round({_MEAN}, 6) AS p, round({_COVER}, 6) AS c, round({_SKILL}, 6) AS s FROM ({_SPLIT.format('forecast')}) GROUP BY split)", "forecast"))
def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of each split in long form, as they are saved beside a model."""
    df = scoring.add_split(feeds.forecast(spark, sf_dir), test_weeks=1, val_weeks=1)
    return models.metric_rows(_scores(df, ["split"], ["n", "mean_pinball", "coverage", "skill"]), ["split"])


@query(sql("SELECT region, ts, round(q50 - 10, 4) AS q10, q50, round(q50 + 10, 4) AS q90 FROM forecast", "forecast"))
def scorer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer over pandas batches, plugged in: yesterday's value with a fixed band."""
    f = feeds.forecast(spark, sf_dir).select("region", "ts", "q50")
    schema = "region string, ts timestamp_ntz, q10 double, q50 double, q90 double"
    return models.score_with(f, ["region", "ts"], schema, lambda p: {"q10": (p.q50 - 10).round(4), "q50": p.q50, "q90": (p.q50 + 10).round(4)})


def _trend(pdf):
    import pandas as pd

    x, y = (pdf["ts"] - pd.Timestamp("2024-01-01")).dt.total_seconds() / 86400, pdf["value"]
    var = ((x - x.mean()) ** 2).sum()
    slope = ((x - x.mean()) * (y - y.mean())).sum() / var if var > 0 else None
    return pd.DataFrame({"site": [pdf["site"].iloc[0]], "n": [len(pdf)], "slope": [slope]})


@query("SELECT user_id AS site, count(*) AS n, round(regr_slope(value, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 86400000000.0), 3) AS slope FROM events GROUP BY user_id")
def train_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small model for each site: the trend of its readings a day."""
    r = feeds.readings(spark, sf_dir).select("site", "ts", "value")
    return models.train_each(r, ["site"], _trend, "site long, n long, slope double").withColumn("slope", F.round("slope", 3))
