"""Splits, quantile metrics, calibration, champion selection and serving slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.operators.prefix import Running, running

QUANTILES = {"q10": 0.1, "q50": 0.5, "q90": 0.9}


def add_split(df: DataFrame, ts: str = "ts", test_weeks: int = 8, val_weeks: int = 8, val_start: Column | None = None, test_start: Column | None = None) -> DataFrame:
    """split: train, val or test, by given dates or counted back from the last time."""
    last = df.agg(F.max(ts).alias("_last"))
    out = df.join(F.broadcast(last), F.lit(True))  # one row
    weeks = lambda n: F.expr(f"INTERVAL '{7 * n}' DAY")
    test = test_start if test_start is not None else F.col("_last") - weeks(test_weeks)
    val = val_start if val_start is not None else test - weeks(val_weeks)
    return out.withColumn("split", F.when(F.col(ts) >= test, "test").when(F.col(ts) >= val, "val").otherwise("train")).drop("_last")


def time_folds(df: DataFrame, k: int, keys: list[str], ts: str = "ts") -> DataFrame:
    """fold 1..k: the expanding-window validation block of a row within its key, 0 for rows that only train. Fold i trains on
    the rows before its block."""
    df = running(df, keys, {"_at": Running("count"), "_n": Running("count", whole=True)}, ts=ts)
    n, at = F.col("_n"), F.col("_at") - 1
    block = F.floor(n / (k + 1))
    first = n - k * block
    return df.withColumn("fold", F.when((block > 0) & (at >= first), F.floor((at - first) / block) + 1).otherwise(0).cast("int")).drop("_at", "_n")


def pinball(y: Column, q: Column, level: float) -> Column:
    return F.avg(F.greatest(level * (y - q), (level - 1) * (y - q)))


def score(df: DataFrame, by: list[str], y: str = "y", base: str | None = None) -> DataFrame:
    """Pinball losses, coverage of [q10, q90], crossing rate and skill of q50 against a baseline on complete pairs."""
    t, a, b, c = F.col(y), F.col("q10"), F.col("q50"), F.col("q90")
    losses = {q: pinball(t, F.col(q), level) for q, level in QUANTILES.items()}
    out = [F.count("*").alias("n"), *(v.alias(f"pinball_{q}") for q, v in losses.items()), ((losses["q10"] + losses["q50"] + losses["q90"]) / 3).alias("mean_pinball")]
    out += [F.avg(t.between(a, c).cast("double")).alias("coverage"), F.avg(((b - a < -1e-9) | (c - b < -1e-9)).cast("double")).alias("crossing_rate")]
    if base:
        pair = t.isNotNull() & b.isNotNull() & F.col(base).isNotNull()
        own, other = F.avg(F.when(pair, F.abs(t - b))), F.avg(F.when(pair, F.abs(t - F.col(base))))
        out += [F.count_if(pair).alias("n_pairs"), (1 - own / F.nullif(other, F.lit(0.0))).alias("skill")]
    return df.groupBy(*by).agg(*out)


def calibration(df: DataFrame, y: str = "y") -> DataFrame:
    """Share of targets not above each quantile, in long form."""
    shares = df.agg(*(F.avg((F.col(y) <= F.col(q)).cast("double")).alias(q) for q in QUANTILES))
    return shares.select(F.inline(F.array(*(F.struct(F.lit(v).alias("quantile"), F.col(q).alias("empirical")) for q, v in QUANTILES.items()))))


def mae_by_hour(df: DataFrame, y: str = "y", q: str = "q50", ts: str = "ts") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.avg(F.abs(F.col(y) - F.col(q))).alias("mae"), F.count("*").alias("n"))


def monotone(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sorts each row's quantiles in ascending order."""
    row = F.array_sort(F.array(*columns))
    return df.withColumn("_q", row).withColumns({c: F.get("_q", F.lit(k)) for k, c in enumerate(columns)}).drop("_q")


def to_power(df: DataFrame, columns: list[str], capacity: str) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.col(capacity) for c in columns})


def capacity_share(value: Column, capacity: Column) -> Column:
    return value / F.greatest(capacity, F.lit(1e-6))


def night_zero(df: DataFrame, columns: list[str], day: str = "is_daylight", floor: bool = False) -> DataFrame:
    """0 at night (an unknown flag counts as night); with floor negatives are 0 too and NULL stays NULL."""
    value = lambda c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0))) if floor else F.col(c)
    return df.withColumns({c: F.when(F.col(day) == 1, value(c)).otherwise(0.0) for c in columns})


def daylight_only(df: DataFrame) -> DataFrame:
    """Rows by the daylight flag, else by elevation, else all."""
    if "is_daylight" in df.columns:
        return df.where("is_daylight = 1")
    return df.where("solar_elevation_deg > 0") if "solar_elevation_deg" in df.columns else df


def select_champion(runs: DataFrame, score_col: str = "score", incumbent: str = "is_champion", force: bool = False) -> DataFrame:
    """The run to publish: the best challenger if it is strictly better than the incumbent (or forced); no score is infinity."""
    value = F.coalesce(F.nanvl(F.col(score_col).cast("double"), F.lit(float("inf"))), F.lit(float("inf")))
    runs = runs.withColumn("_s", value)
    own = F.when(F.col(incumbent), F.struct("_s", "run_id"))
    new = F.when(~F.col(incumbent), F.struct("_s", "run_id"))
    best = runs.agg(F.min(own).alias("own"), F.min(new).alias("new"))
    better = F.col("new").isNotNull() & (F.col("own").isNull() | F.lit(force) | (F.col("new._s") < F.col("own._s")))
    return best.select(F.when(better, F.col("new.run_id")).otherwise(F.col("own.run_id")).alias("run_id"), better.alias("promoted"))


def forecast_origin(df: DataFrame, keys: list[str], y: str, capacity: str, ts: str = "ts") -> DataFrame:
    """Per key the last slot with an observation and the last known capacity."""
    return df.groupBy(*keys).agg(F.max(F.when(F.col(y).isNotNull(), F.col(ts))).alias("origin"), F.max_by(capacity, F.when(F.col(capacity).isNotNull(), F.col(ts))).alias("capacity"))


def forward_path(df: DataFrame, keys: list[str], value: str, until: Column, days: int = 10, most: int = 64, ts: str = "ts", step: int = 30) -> DataFrame:
    """History-only forecast of each key's own path: from the slot after the last observed one to `until`, at least 1 and at
    most `most` steps, quantiles of the values at the same time of day in the `days` days up to the last observed slot.

    Adds `origin`. History meets the future slots in an equi-join on key and time of day, and only its last days do.
    """
    last = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(ts).alias("origin"))
    n = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.timestamp_diff("MINUTE", F.col("origin"), until) / step).cast("int")))
    future = last.select(*keys, "origin", F.explode(F.sequence(F.lit(1), n)).alias("_k"))
    of_day = lambda t: F.timestamp_diff("MINUTE", F.date_trunc("day", t).cast("timestamp_ntz"), t)
    future = future.withColumn(ts, F.col("origin") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("_k") * step)).withColumn("_at", of_day(F.col(ts))).drop("_k")
    past = df.join(last, keys).where((F.col(ts) <= F.col("origin")) & (F.col(ts) > F.col("origin") - F.make_dt_interval(F.lit(days))) & F.col(value).isNotNull())
    past = past.select(*keys, of_day(F.col(ts)).alias("_at"), F.col(value).alias("_v"))
    levels = F.percentile("_v", F.array(*map(F.lit, QUANTILES.values())))
    out = future.join(past, [*keys, "_at"], "left").groupBy(*keys, "origin", ts).agg(levels.alias("_q"))
    return out.select(*keys, "origin", ts, *(F.get("_q", F.lit(k)).alias(q) for k, q in enumerate(QUANTILES)))


def serve(path: DataFrame, table: DataFrame, keys: list[str], capacity: str, day: str, ts: str = "ts") -> DataFrame:
    """A path of capacity factors in power: not below 0, times the capacity at the target time or, where that is unknown, the
    key's last known one; 0 at night, an unknown flag counting as day."""
    last = table.groupBy(*keys).agg(F.max_by(capacity, F.when(F.col(capacity).isNotNull(), F.col(ts))).alias("_last"))
    at = table.select(*keys, ts, F.col(capacity).alias("_own"), F.col(day).alias("_day"))
    out = path.join(at, [*keys, ts], "left").join(last, keys, "left").withColumn(capacity, F.coalesce("_own", "_last"))
    lit = F.coalesce(F.col("_day") == 1, F.lit(True))
    value = lambda q: F.when(F.col(q).isNotNull(), F.when(lit, F.greatest(F.col(q), F.lit(0.0)) * F.col(capacity)).otherwise(0.0))
    return out.withColumns({q: value(q) for q in QUANTILES}).drop("_own", "_last", "_day")


def live_slice(df: DataFrame, now: Column, ts: str = "ts") -> DataFrame:
    return df.where(F.col(ts) >= now)


def recent_slice(df: DataFrame, now: Column, days: int = 14, ts: str = "ts") -> DataFrame:
    return df.where((F.col(ts) < now) & (F.col(ts) >= now - F.expr(f"INTERVAL '{days}' DAY")))


def forecast_lookup(published: DataFrame, model: str, horizon: int, fallback: str = "default") -> DataFrame:
    """The latest published forecast of a model and horizon, or else of the fallback model."""
    own = published.where((F.col("horizon") == horizon) & F.col("model").isin(model, fallback))
    best = own.agg(F.max(F.struct((F.col("model") == model).alias("own"), F.col("published").alias("at"))).alias("b"))
    hit = (F.col("model") == F.when(F.col("b.own"), F.lit(model)).otherwise(F.lit(fallback))) & (F.col("published") == F.col("b.at"))
    return own.join(F.broadcast(best), hit).drop("b")


def seasonal_quantiles(df: DataFrame, keys: list[str], value: str, horizon: int, days: int = 10, period: int = 48, ts: str = "ts") -> DataFrame:
    """History-only baseline at a fixed lead: quantiles of the values at the same time of day, known `horizon` rows before.

    The same time of day lies period * k rows back; the first such k is the first that respects the horizon.
    """
    w, first = Window.partitionBy(*keys).orderBy(ts), -(-horizon // period)
    past = F.filter(F.array(*(F.lag(value, period * k).over(w) for k in range(first, first + days))), lambda x: x.isNotNull())
    out = df.withColumn("_past", F.array_sort(past)).where(F.size("_past") > 0)

    def at(level: float) -> Column:
        place = F.lit(level) * (F.size("_past") - 1)
        lo = F.floor(place).cast("int")
        a, b = F.get("_past", lo), F.get("_past", F.least(lo + 1, F.size("_past") - 1))
        return a + (b - a) * (place - lo)

    return out.withColumns({q: at(level) for q, level in QUANTILES.items()}).drop("_past")
