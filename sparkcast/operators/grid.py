"""Regular time grids: gap-free spines, fills, gap flags, and windows over blocks of very long series.

A frame has key columns `keys` and a time column `ts`. All windows share one partitioning and order, so Spark plans one
exchange and one sort for a chain of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.functions.columns import floor_slot, minutes
from sparkcast.operators.prefix import Running, running


#: Rows of a grid that one task sorts.
TASK_ROWS = 500_000


def by_time(keys: list[str], ts: str = "ts"):
    return Window.partitionBy(*keys).orderBy(ts)


def site_to_fleet(readings: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", step: int = 30) -> DataFrame:
    """Sum (0 if all values are NULL) and count of the values of all sites per slot; rows without keys or time go."""
    known = readings.where(F.col(ts).isNotNull())
    return known.groupBy(*keys, floor_slot(ts, step).alias("ts")).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("total"), F.count(value).alias("n"))


def canonical_grid(df: DataFrame, keys: list[str], ts: str = "ts", step: int = 30) -> DataFrame:
    """Per key every slot between its first and last time; slots without a row get NULLs."""
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", minutes(step))).alias(ts))
    return grid.join(df, [*keys, ts], "left")


def grid_parts(df: DataFrame, keys: list[str], ts: str = "ts", step: int = 30) -> int:
    """The number of partitions that gives a task about TASK_ROWS rows of df's canonical grid, told by the keys' first and last times."""
    slots = F.timestamp_diff("MINUTE", F.min(ts), F.max(ts)) / step + 1
    rows = df.groupBy(*keys).agg(slots.alias("n")).agg(F.sum("n")).first()[0] or 0
    return max(1, -(-int(rows) // TASK_ROWS))


def extend_spine(df: DataFrame, keys: list[str], until: Column, carry: list[str], ts: str = "ts", step: int = 30) -> DataFrame:
    """Adds slots after each key's last one up to `until`, carrying the last values of some columns."""
    last = df.groupBy(*keys).agg(F.max(ts).alias("_last"), *(F.max_by(c, ts).alias(c) for c in carry))
    start = F.col("_last") + minutes(step)
    slots = F.when(start <= until, F.sequence(start, until, minutes(step)))
    return df.unionByName(last.select(*keys, F.explode(slots).alias(ts), *carry), allowMissingColumns=True)


def forward_fill(df: DataFrame, keys: list[str], columns: list[str], limit: int | None = None, ts: str = "ts") -> DataFrame:
    """Last known value, at most `limit` rows old."""
    w = by_time(keys, ts).rowsBetween(Window.unboundedPreceding if limit is None else -limit, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def with_neighbours(df: DataFrame, keys: list[str], columns: list[str], days: int = 30, ts: str = "ts", parts: int | None = None) -> DataFrame:
    """For each column c the structs _prev_c and _next_c (at, value): the nearest known value not after and not before a row;
    and _lo and _hi, the key's first and last time. One very long series uses many tasks."""
    # times and values run apart, as aggregates of structs can't be hashed
    what = {}
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col(ts))
        for side, back in (("prev", False), ("next", True)):
            what |= {f"_{side}_at_{c}": Running("last", at, back), f"_{side}_value_{c}": Running("last", F.col(c), back)}
    whole = {"_lo": Running("min", F.col(ts), whole=True), "_hi": Running("max", F.col(ts), whole=True)}
    out = running(df, keys, what | whole, days, ts, parts=parts)
    near = lambda side, c: F.when(F.col(f"_{side}_at_{c}").isNotNull(), F.struct(F.col(f"_{side}_at_{c}").alias("at"), F.col(f"_{side}_value_{c}").alias("value")))
    return out.select(*df.columns, "_lo", "_hi", *(near(side, c).alias(f"_{side}_{c}") for c in columns for side in ("prev", "next")))


def fill_both_ways(df: DataFrame, keys: list[str], columns: list[str], ts: str = "ts") -> DataFrame:
    """Forward, then backward for what is left at the start."""
    out = with_neighbours(df, keys, columns, ts=ts)
    return out.select(*(F.coalesce(F.col(f"_prev_{c}.value"), F.col(f"_next_{c}.value")).alias(c) if c in columns else F.col(c) for c in df.columns))


def gap_policy(df: DataFrame, keys: list[str], value: str, max_fill: int = 1, long_gap: int = 6, strict: bool = False, ts: str = "ts", step: int = 30, parts: int | None = None) -> DataFrame:
    """Fills short gaps and flags every slot `ok`, `ffill`, `gap` or `long_gap` in data_quality_flag; rows must be a grid.

    A gap's first max_fill slots are filled whatever its length; strict fills gaps of up to max_fill slots only. A gap at a
    key's start has nothing to be filled with and stays NULL, flagged by its length.
    """
    near = with_neighbours(df, keys, [value], ts=ts, parts=parts)
    slots = lambda a, b: F.timestamp_diff("MINUTE", a, b) / step
    prev, after = F.col(f"_prev_{value}.at"), F.col(f"_next_{value}.at")
    before, beyond = F.coalesce(prev, F.col("_lo") - minutes(step)), F.coalesce(after, F.col("_hi") + minutes(step))
    length, missing = slots(before, beyond) - 1, F.col(value).isNull()
    flag = F.when(~missing, "ok").when(length <= max_fill, "ffill").when(length > long_gap, "long_gap").otherwise("gap")
    held = F.when(slots(prev, F.col(ts)) <= max_fill, F.col(f"_prev_{value}.value"))
    new = F.when(~missing | (length <= max_fill), held) if strict else held
    rest = [new.alias(c) if c == value else F.col(c) for c in df.columns if c != "data_quality_flag"]
    return near.select(*rest, flag.alias("data_quality_flag"))


def dedup_latest(df: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """One row per key: the one with the newest stamp, even if its values are NULL; a NULL stamp counts as newest.

    A partial aggregate keeps one row a key and task before anything is shuffled.
    """
    return _picked(df, keys, F.max_by, F.struct(F.col(stamp).isNull().alias("a"), F.col(stamp).alias("b")))


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order, NULLs first."""
    return _picked(df, keys, F.min_by, F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order))))


def _picked(df: DataFrame, keys: list[str], pick, order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_r"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def align(df: DataFrame, columns: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """Exactly the given columns (name to type) in their order, after renaming; what is missing is NULL."""
    df = df.withColumnsRenamed(rename or {})
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()))


def with_halo(df: DataFrame, keys: list[str], days: int, before: int, after: int = 0, step: int = 30, ts: str = "ts") -> DataFrame:
    """Deals each series into blocks of `days`, each with copies of the rows up to `before` slots earlier and `after` later.

    Finite windows may then be partitioned by (keys, block), so one very long series uses many tasks; drop rows with `halo`
    afterwards.
    """
    width = days * 86400
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    own = F.floor(seconds / width)
    first, last = F.floor((seconds - after * step * 60) / width), F.floor((seconds + before * step * 60) / width)
    return df.withColumn("block", F.explode(F.sequence(first, last))).withColumn("halo", F.col("block") != own)


def in_blocks(df: DataFrame, keys: list[str], before: int, fn: Callable[[DataFrame, list[str]], DataFrame], days: int = 60, ts: str = "ts") -> DataFrame:
    """fn(rows, keys) over blocks of `days` of a grid, for windows that reach `before` slots back: one very long series uses many
    tasks, and the rows are the same."""
    return fn(with_halo(df, keys, days, before, ts=ts), [*keys, "block"]).where(~F.col("halo")).drop("block", "halo")
