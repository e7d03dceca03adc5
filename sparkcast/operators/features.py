"""Leakage-safe features: lags, rolling statistics, targets, calendar and solar columns, sequences and contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.functions.columns import calendar, clearsky_ghi, clip, solar_cosine, solar_elevation
from sparkcast.operators.grid import by_time
from sparkcast.operators.prefix import Running, running

#: Half-hours of the usual lags in order: a day, two days, three days, a week.
USUAL_LAGS = (48, 96, 144, 336)


def known_lags(horizon: int) -> list[int]:
    """The horizon itself, the youngest value known when a forecast is made, and the usual lags beyond it."""
    return [horizon, *(k for k in USUAL_LAGS if k > horizon)]


def add_lags(df: DataFrame, keys: list[str], columns: dict[str, str], horizon: int, ts: str = "ts") -> DataFrame:
    """name_lag_N for each column (name -> column) and each lag of the horizon; rows must be a grid."""
    w = by_time(keys, ts)
    return df.withColumns({f"{name}_lag_{k}": F.lag(c, k).over(w).cast("float") for name, c in columns.items() for k in known_lags(horizon)})


def add_history_flag(df: DataFrame, keys: list[str], horizon: int, ts: str = "ts") -> DataFrame:
    """has_full_history: whether a row has more rows before it than the longest lag goes back."""
    counted = running(df, keys, {"_before": Running("count")}, ts=ts)
    return counted.withColumn("has_full_history", (F.col("_before") - 1 >= max(known_lags(horizon)) + 1).cast("byte")).drop("_before")


def add_rolling(df: DataFrame, keys: list[str], columns: dict[str, str], horizon: int, sizes: tuple[int, ...] = (48, 336), std: tuple[int, ...] = (48,), std_of: tuple[str, ...] = (), ts: str = "ts") -> DataFrame:
    """Means (and sample deviations) of the `size` rows that end `horizon` rows back, if half of them are known."""
    new = {}
    for name, c in columns.items():
        for n in sizes:
            w = by_time(keys, ts).rowsBetween(-(horizon + n - 1), -horizon)
            enough = F.count(c).over(w) >= n // 2
            new[f"{name}_roll_mean_{n}"] = F.when(enough, F.avg(c).over(w)).cast("float")
            if n in std and name in std_of:
                new[f"{name}_roll_std_{n}"] = F.when(enough, F.stddev_samp(c).over(w)).cast("float")
    return df.withColumns(new)


def add_targets(df: DataFrame, generation: str, capacity: str) -> DataFrame:
    """target_mw and the capacity factor target_cf in [0, 1.5]; NULL where generation or a positive capacity is unknown."""
    cf = F.col(generation) / F.when(F.col(capacity) != 0, F.col(capacity))
    return df.withColumns({"target_mw": F.col(generation), "target_cf": clip(cf, 0.0, 1.5)})


def add_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(calendar(ts))


def add_solar(df: DataFrame, lat, lon, ts: str = "ts") -> DataFrame:
    """solar_elevation_deg, clearsky_cos (not below 0), is_daylight and clearsky_ghi; lat and lon may be columns."""
    cosine = solar_cosine(ts, lat, lon)
    elevation = solar_elevation(cosine)
    return df.withColumns({"solar_elevation_deg": elevation, "clearsky_cos": F.greatest(cosine, F.lit(0.0)), "is_daylight": (elevation > 0).cast("byte"), "clearsky_ghi": clearsky_ghi(elevation)})


def _numbered(df: DataFrame, keys: list[str], step: int | None, ts: str) -> DataFrame:
    """df with the number `_at` of each row's slot, or of the row itself if there is no step."""
    if step is None:
        return running(df, keys, {"_at": Running("count")}, ts=ts)
    return df.withColumn("_at", F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz")) / (60 * step)))


def _chunks(rows: DataFrame, keys: list[str], value: Column, length: int) -> DataFrame:
    """(keys, _chunk, _cells): the values of two neighbouring chunks of `length` numbered places each, NULL where there is no row.

    A value goes into one chunk, and a chunk once more to the next one, instead of into each of the arrays that contain it.
    """
    place = rows.select(*keys, F.floor(F.col("_at") / length).alias("_chunk"), F.pmod("_at", F.lit(length)).cast("int").alias("_k"), value.alias("_v"))
    packed = place.groupBy(*keys, "_chunk").agg(F.array_sort(F.collect_list(F.struct("_k", "_v"))).alias("_c"))
    # the array around the map has it built once, not once a place
    spread = F.get(F.transform(F.array(F.map_from_entries("_c")), lambda m: F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda k: F.try_element_at(m, k))), F.lit(0))
    own = packed.select(*keys, "_chunk", F.when(F.size("_c") == length, F.transform("_c", lambda x: x["_v"])).otherwise(spread).alias("_own"))
    last = own.select(*keys, (F.col("_chunk") + 1).alias("_chunk"), F.col("_own").alias("_last"))
    both = own.join(last, [*keys, "_chunk"], "full")
    none = F.transform(F.sequence(F.lit(1), F.lit(length)), lambda k: F.get("_own", F.lit(-1)))
    return both.select(*keys, "_chunk", F.concat(F.coalesce("_last", none), F.coalesce("_own", none)).alias("_cells"))


def _with_window(rows: DataFrame, chunks: DataFrame, keys: list[str], end: Column, length: int, name: str) -> DataFrame:
    """rows with the `length` values that end at place `end`, where all of them are there."""
    found = rows.withColumns({"_end": end, "_chunk": F.floor(end / length)}).join(chunks, [*keys, "_chunk"])
    found = found.withColumn(name, F.slice("_cells", F.pmod("_end", F.lit(length)).cast("int") + 2, length))
    return found.where(~F.exists(name, lambda x: x.isNull())).drop("_end", "_chunk", "_cells")


def sequence_windows(df: DataFrame, keys: list[str], features: list[str], length: int, contiguous_step: int | None = None, ts: str = "ts") -> DataFrame:
    """The last `length` feature rows as an array of arrays, for rows that have as many. With a step in minutes the rows of a
    sequence are unbroken slots, otherwise whatever rows follow each other."""
    rows = _numbered(df, keys, contiguous_step, ts)
    chunks = _chunks(rows, keys, F.array(*(F.col(c).cast("float") for c in features)), length)
    return _with_window(rows, chunks, keys, F.col("_at"), length, "sequence").select(*df.columns, "sequence")


def history_context(df: DataFrame, keys: list[str], value: str, length: int, horizon: int, stride: int = 1, most: int | None = None, ts: str = "ts", step: int = 30) -> DataFrame:
    """`length` values that end `horizon` slots before a known target, NULL counting as 0; every stride-th row of a key, and at
    most `most` of them, on request. Rows must be a grid, so that it is known which rows have a context before any is built."""
    rows = _numbered(df, keys, step, ts)
    chunks = _chunks(rows, keys, F.coalesce(F.col(value), F.lit(0.0)), length)
    wanted = rows.where(F.col(value).isNotNull())
    if stride > 1 or most is not None:
        first = rows.groupBy(*keys).agg(F.min("_at").alias("_first"))
        wanted = wanted.join(first, keys).where(F.col("_at") - F.col("_first") >= horizon + length - 1).drop("_first")
        wanted = running(wanted, keys, {"_n": Running("count")}, ts=ts).where((F.col("_n") - 1) % stride == 0)
        if most is not None:
            wanted = wanted.where(F.col("_n") <= most * stride)
    return _with_window(wanted, chunks, keys, F.col("_at") - horizon, length, "context").select(*df.columns, "context")


def fit_standardizer(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation of each column; unknown means are 0, unknown or zero deviations 1."""
    means = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}_mean") for c in columns]
    return df.agg(*means, *(F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_std") for c in columns))


def standardize(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / deviation with NULL taken as the mean; `stats` is one row."""
    both = df.join(F.broadcast(stats), F.lit(True))
    return both.select(*(((F.coalesce(F.col(c), F.col(f"{c}_mean")) - F.col(f"{c}_mean")) / F.col(f"{c}_std")).alias(c) if c in columns else F.col(c) for c in df.columns))


def feature_columns(df: DataFrame, deny: set[str]) -> list[str]:
    """Numeric columns that are not on the deny-list."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [c for c, t in df.dtypes if t in numeric and c not in deny]


def training_rows(df: DataFrame, target: str, driver: str) -> DataFrame:
    """Rows with a full history, a known target and a known main driver."""
    return df.where((F.col("has_full_history") == 1) & F.col(target).isNotNull() & F.col(driver).isNotNull())
