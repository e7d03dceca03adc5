"""Joins of feeds: as-of with a horizon, latest issue, weighted spatial means, left fusion on a spine, nearest grid cells."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.functions.columns import minutes
from sparkcast.operators.prefix import Running, running


def fuse(spine: DataFrame, sources: list[DataFrame], on: list[str]) -> DataFrame:
    """Left joins on the same columns, so one exchange of the spine serves all."""
    return reduce(lambda a, b: a.join(b, on, "left"), sources, spine)


def asof_horizon(cube: DataFrame, horizon: int, by: list[str], init: str = "init", valid: str = "ts", step: int = 30) -> DataFrame:
    """Per valid time the row of the newest init that is at least `horizon` steps older (inclusive), NULL values and all.

    The newest row comes from a partial aggregate, so nothing is sorted and only one row a group and task is shuffled.
    """
    known = cube.where(F.col(init) <= F.col(valid) - minutes(step * horizon))
    rest = [c for c in cube.columns if c not in {*by, valid}]
    best = known.groupBy(*by, valid).agg(F.max_by(F.struct(*rest), F.col(init)).alias("_r"))
    return best.select(*by, valid, *(F.col(f"_r.{c}").alias(c) for c in rest))


def latest_issue(log: DataFrame, by: list[str], issued: str = "issue", valid: str = "ts", tie: str | None = None, lead: int = 0, step: int = 30) -> DataFrame:
    """Per slot the newest issue not later than the slot less `lead` steps; an unknown issue time loses to all known ones."""
    known = log.where(F.col(issued).isNull() | (F.col(issued) <= F.col(valid) - minutes(step * lead)))
    rest = [c for c in log.columns if c not in {*by, valid}]
    order = F.struct(F.col(issued).isNotNull().alias("a"), F.col(issued).alias("b"), *([F.col(tie).alias("c")] if tie else []))
    best = known.groupBy(*by, valid).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*by, valid, *(F.col(f"_r.{c}").alias(c) for c in rest))


def normalised_weights(weights: DataFrame, weight: str | None = "weight") -> DataFrame:
    """Weights that sum to 1; equal ones if there is no weight column. One total joins back to the small table."""
    w = weights if weight and weight in weights.columns else weights.withColumn("weight", F.lit(1.0))
    name = weight if weight and weight in weights.columns else "weight"
    total = w.agg(F.sum(name).alias("_total"))
    return w.crossJoin(F.broadcast(total)).withColumn(name, F.col(name) / F.when(F.col("_total") != 0, F.col("_total")).otherwise(1.0)).drop("_total")  # one row


def weighted_mean(df: DataFrame, by: list[str], variables: list[str], weight: str) -> DataFrame:
    """Weighted means of a group; one NULL value makes the group's mean NULL, as does a total weight of 0."""
    w = F.col(weight)
    means = [F.when((F.sum(w) > 0) & (F.count(v) == F.count("*")), F.sum(F.col(v) * w) / F.sum(w)).alias(v) for v in variables]
    return df.groupBy(*by).agg(*means)


def lookup(df: DataFrame, dimension: DataFrame, on: str, value: str, default: float = 0.0, most: int = 100_000) -> DataFrame:
    """Left join with a dimension table, unmatched rows getting the default; broadcast only if it has `most` rows or fewer."""
    small = dimension.limit(most + 1).count() <= most
    return df.join(F.broadcast(dimension) if small else dimension, on, "left").fillna(default, [value])


def merge_partials(parts: list[DataFrame], by: list[str], sums: list[str]) -> DataFrame:
    """Adds partial aggregates of several runs."""
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return union.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums))


def laea(lat: Column, lon: Column, lat0: float, lon0: float, major: float = 6378137.0, minor: float = 6356752.314140356) -> tuple[Column, Column]:
    """Lambert azimuthal equal-area coordinates on the ellipsoid (Snyder 1987, oblique aspect)."""
    e2 = 1 - (minor / major) ** 2
    e = math.sqrt(e2)

    def q_of(s):  # s is the sine of the latitude; works on numbers and columns
        log = math.log if isinstance(s, float) else F.log
        return (1 - e2) * (s / (1 - e2 * s * s) - 1 / (2 * e) * log((1 - e * s) / (1 + e * s)))

    qp, phi0 = q_of(1.0), math.radians(lat0)
    beta0, rq = math.asin(q_of(math.sin(phi0)) / qp), major * math.sqrt(qp / 2)
    d = major * math.cos(phi0) / math.sqrt(1 - e2 * math.sin(phi0) ** 2) / (rq * math.cos(beta0))
    beta, turn = F.asin(q_of(F.sin(F.radians(lat))) / qp), F.radians(lon - lon0)
    b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(turn)))
    return b * d * F.cos(beta) * F.sin(turn), b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(turn))


#: Blocks of an axis that nearest ticks are searched in, each in a task.
AXIS_BLOCKS = 256


def nearest(values: DataFrame, ticks: DataFrame) -> DataFrame:
    """(value, tick): each distinct value with the tick nearest to it, of two equally near the smaller. Both frames have one
    numeric column; NULLs are left out.

    Values and ticks are laid on one axis, which is cut into blocks of about as many values. The ticks next to a value on either
    side are the last known ones of a scan from the left and from the right, so nothing is paired, however many there are.
    """
    on_axis = lambda df, tick: df.select(F.col(df.columns[0]).cast("double").alias("v"), F.lit(tick).alias("tick")).where("v is not null")
    axis = on_axis(values, False).union(on_axis(ticks, True)).groupBy("v").agg(F.max("tick").alias("tick"), F.max(~F.col("tick")).alias("asked"))
    bounds = axis.agg(F.percentile_approx("v", [k / AXIS_BLOCKS for k in range(1, AXIS_BLOCKS)], 10_000).alias("b")).first().b or []
    block = F.size(F.filter(F.lit(sorted(set(bounds))), lambda b: b <= F.col("v"))) if bounds else F.lit(0)
    at = F.when(F.col("tick"), F.col("v"))
    both = running(axis, [], {"lower": Running("last", at), "upper": Running("last", at, backward=True)}, ts="v", block=block)
    below, above = F.col("v") - F.col("lower"), F.col("upper") - F.col("v")
    tick = F.when(F.col("upper").isNull() | (below <= above), F.col("lower")).otherwise(F.col("upper"))
    return both.where("asked").select(F.col("v").alias("value"), tick.alias("tick")).where("tick is not null")


def sample_points(field: DataFrame, points: DataFrame, by: list[str]) -> DataFrame:
    """The field's value at the cell nearest to each named point (name, px, py), by x and y independently, for any number of
    points and cells. A point with a NULL coordinate, or whose nearest x and y make no cell, gives no row."""
    cells = points.select("name", F.col("px").cast("double").alias("px"), F.col("py").cast("double").alias("py"))
    for axis in ("x", "y"):
        near = nearest(points.select(f"p{axis}"), field.select(axis)).toDF(f"p{axis}", f"_{axis}")
        cells = cells.join(near, f"p{axis}")
    cells = cells.select("name", *(F.col(f"_{axis}").cast(field.schema[axis].dataType).alias(axis) for axis in ("x", "y")))
    return field.join(cells, ["x", "y"]).select(*by, "name", "x", "y", "value")
