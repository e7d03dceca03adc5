"""Range rules, contracts, coverage and cross-checks, each as one aggregate over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A hard rule is violated."""


def clamp_range(df: DataFrame, bounds: dict[str, tuple[float, float]], seen: Observation | None = None) -> DataFrame:
    """Values outside their inclusive bounds become NULL. An Observation counts them by column as the rows go by, without a
    job of its own."""
    if seen is not None:
        df = df.observe(seen, *(n.alias(c) for c, n in _outside(bounds).items()))
    return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in bounds.items()})


def _outside(bounds: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: F.count_if(~F.col(c).between(lo, hi)) for c, (lo, hi) in bounds.items()}


def clamp_counts(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows (column, n): how many values clamp_range takes away."""
    counts = df.agg(*(n.alias(c) for c, n in _outside(bounds).items()))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in bounds))))


def clamp_capacity(df: DataFrame, value: str, capacity: str, factor: float = 1.5) -> DataFrame:
    """Negative values, and values above factor * capacity where that is known and positive, become NULL."""
    v, cap = F.col(value), F.col(capacity)
    bad = (v < 0) | (cap.isNotNull() & (cap > 0) & (v > cap * factor))
    return df.withColumn(value, F.when(~F.coalesce(bad, F.lit(False)), v))


def drop_leaky(df: DataFrame, issued: str, valid: str, keep_unknown: bool = False) -> DataFrame:
    """Rows issued after the time they are about go; rows with an unknown issue time stay on request."""
    ok = F.col(issued) <= F.col(valid)
    return df.where(ok | F.col(issued).isNull() if keep_unknown else ok)


def violations(df: DataFrame, rules: dict[str, Column], unique: list[str] | None = None) -> DataFrame:
    """One row per rule: how many rows are against it. A rule holds where its condition is true or unknown."""
    counts = [F.count_if(~F.coalesce(ok, F.lit(True))).alias(name) for name, ok in rules.items()]
    out = df.agg(*counts)
    if unique:
        repeats = df.groupBy(*unique).count().agg(F.count_if(F.col("count") > 1).alias("unique"))
        out = out.crossJoin(repeats)  # one row each
    names = [*rules, *(["unique"] if unique else [])]
    return out.select(F.inline(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in names))))


def check(df: DataFrame, rules: dict[str, Column], unique: list[str] | None = None, warn: set[str] = frozenset()) -> dict[str, int]:
    """Raises ContractError if a rule that is not only a warning is violated; returns all counts."""
    found = {r.rule: r.n for r in violations(df, rules, unique).collect()}
    hard = {k: v for k, v in found.items() if v and k not in warn}
    if hard:
        raise ContractError(f"violated: {hard}")
    return found


def warnings(values: dict[str, tuple[DataFrame, str, float]]) -> DataFrame:
    """Rows (rule, severity, value, least, holds) of soft rules: `value` (a column of a one-row frame) is to be at least
    `least`; one that is unknown holds. Nothing is raised."""
    rows = [df.select(F.lit(rule).alias("rule"), F.lit("warn").alias("severity"), F.col(c).cast("double").alias("value"), F.lit(float(least)).alias("least")) for rule, (df, c, least) in values.items()]
    out = reduce(DataFrame.union, rows)
    return out.withColumn("holds", F.coalesce(F.col("value") >= F.col("least"), F.lit(True)))


def coverage(df: DataFrame, keys: list[str], ts: str = "ts", step: int = 30) -> DataFrame:
    """Rows as a share of the slots between a key's first and last time."""
    span = F.timestamp_diff("SECOND", F.min(ts), F.max(ts)) / (60.0 * step) + 1
    return df.groupBy(*keys).agg(F.count("*").alias("n"), span.alias("expected"), (F.count("*") / span).alias("coverage"))


def cross_correlation(a: DataFrame, b: DataFrame, on: list[str], x: str, y: str, least: int = 100) -> DataFrame:
    """Pearson correlation over common complete rows; NULL unless there are more than `least`."""
    both = a.join(b, on).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.count("*").alias("n"), F.when(F.count("*") > least, F.corr(x, y)).alias("corr"))


def pass_fraction(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.agg(*(F.avg(ok.cast("double")).alias(name) for name, ok in rules.items()))


def modal_step(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """The commonest distance in seconds between a key's consecutive rows; the smallest of equally common ones."""
    before = F.lag(ts).over(Window.partitionBy(*keys).orderBy(ts))
    steps = df.select(*keys, F.timestamp_diff("SECOND", before, F.col(ts)).alias("step")).where("step is not null")
    counts = steps.groupBy(*keys, "step").count()
    return counts.groupBy(*keys).agg(F.max_by("step", F.struct("count", -F.col("step"))).alias("modal_step"))


def leaks(columns: list[str], horizon: int, observed: list[str], lags: list[int]) -> list[str]:
    """Breaches of the rule that a feature known only after the fact has a lag of the horizon or more."""
    import re

    found = [f"observed column {c}" for c in observed if c in columns]
    for c in columns:
        if (m := re.search(r"_lag_(\d+)$", c)) and int(m[1]) < horizon:
            found.append(f"{c} is younger than the horizon of {horizon}")
    return found + [f"lag {k} is missing" for k in lags if not any(c.endswith(f"_lag_{k}") for c in columns)]


def assert_no_leakage(df: DataFrame, horizon: int, observed: list[str], lags: list[int]) -> DataFrame:
    if found := leaks(df.columns, horizon, observed, lags):
        raise ContractError("; ".join(found))
    return df
