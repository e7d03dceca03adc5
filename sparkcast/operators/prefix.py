"""Running values along very long series, in two levels.

A series is dealt into blocks of time. Each block gives its total, totals are added up over a series' blocks, and inside a block
a window goes on from what lies before it. So one series uses many tasks, and only one row a block meets the others of its
series. Any associative operation will do; here are counts, sums, extremes and the last known value, from either end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: The block of rows without a time, before all others.
NO_TIME = -(2**62)


@dataclass(frozen=True)
class Running:
    """A running value: `kind` is count, sum, min, max or last (the last known value) of a column, or of all rows for a count
    without one; `backward` runs from the end of the series. A row's own value is in it. `whole` is the whole series' value, which
    needs the blocks' totals only."""

    kind: str
    column: Column | None = None
    backward: bool = False
    whole: bool = False

    def _value(self) -> Column:
        return F.lit(1) if self.column is None else self.column

    def total(self, ts: str) -> Column:
        """Of a block."""
        v = self._value()
        if self.kind != "last":
            return getattr(F, self.kind)(v)
        return (F.min_by if self.backward else F.max_by)(v, F.when(v.isNotNull(), F.col(ts)))

    def inside(self, window) -> Column:
        return self._over(self.kind, self._value(), window)

    def before(self, totals: Column, window) -> Column:
        """Of the totals of blocks."""
        return self._over("sum" if self.kind == "count" else self.kind, totals, window)

    @staticmethod
    def _over(kind: str, value: Column, window) -> Column:
        return F.last(value, ignorenulls=True).over(window) if kind == "last" else getattr(F, kind)(value).over(window)

    def both(self, before: Column, inside: Column) -> Column:
        """What lies before a block and what lies inside it, either of which may be NULL."""
        if self.kind in ("count", "sum"):
            return F.coalesce(before + inside, inside, before)
        if self.kind == "last":
            return F.coalesce(inside, before)
        return (F.greatest if self.kind == "max" else F.least)(before, inside)  # NULLs don't count


def block_of(ts: str, days: int) -> Column:
    """The number of the block of `days` that a time is in."""
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    return F.floor(seconds / (days * 86400))


def running(df: DataFrame, keys: list[str], what: dict[str, Running], days: int = 30, ts: str = "ts", block: Column | None = None, parts: int | None = None) -> DataFrame:
    """df with a column for each running value, in the order of `ts` within the keys. `ts` may be any column if `block`, a number
    that doesn't decrease along it, is given.

    `parts` is the number of partitions, for tables that may outgrow the session's.

    Times are unique within the keys; rows without a time come first, in a block of their own. Frames that run from the end are
    written in reverse order, as Spark goes over a frame without an end once for every row.
    """
    dealt = df.withColumn("_block", F.coalesce(block_of(ts, days) if block is None else block, F.lit(NO_TIME))).repartition(*([parts] if parts else []), *keys, "_block")  # once, for the totals and the windows
    totals = dealt.groupBy(*keys, "_block").agg(*(r.total(ts).alias(f"_t_{n}") for n, r in what.items()))
    order = lambda c, back: F.desc(c) if back else F.asc(c)
    series = lambda r: Window.partitionBy(*keys) if r.whole else Window.partitionBy(*keys).orderBy(order("_block", r.backward)).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, "_block", *(r.before(F.col(f"_t_{n}"), series(r)).alias(f"_b_{n}") for n, r in what.items()))
    block = lambda r: Window.partitionBy(*keys, "_block").orderBy(order(ts, r.backward)).rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumns({f"_i_{n}": r.inside(block(r)) for n, r in what.items() if not r.whole})
    both = inside.join(before, [*keys, "_block"], "left")
    value = lambda n, r: F.col(f"_b_{n}") if r.whole else r.both(F.col(f"_b_{n}"), F.col(f"_i_{n}"))
    return both.select(*df.columns, *(value(n, r).alias(n) for n, r in what.items()))
