"""Quality rules: fixed limits on a text's statistics, then robust multivariate outliers by minimum covariance determinant.

Per language and source the most compact CORE share of the documents gives a mean and a covariance of the transformed
statistics. Concentration steps look for it: take the documents nearest to the present mean in the present metric, recompute
both from them, repeat until nothing moves. As in the regularised form of the method the covariance is pulled towards a
target, so that few or constant rows give no zero variance: a group's estimates are means of its own, with weight n / (n +
PRIOR), and its language's, whose own are drawn to those of all rows in the same way. Documents far from the mean in that
metric (Mahalanobis distance, scaled so that its median is that of a normal sample) are rejected; how far is too far is read
off the distances themselves. Built-in expressions only; every step is one aggregate with partial sums, so a group's size
does not matter.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.llm.common import free_name, stored
from sparkcast.llm.sqltext import SPACE, SPACES, trimmed, word_windows

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Share of a group's documents that estimates rest on; the largest move of a covariance, in units of the floors, that ends the
#: concentration steps; and the number of steps after which estimates that still move are taken as they are, with a warning.
CORE, STILL, STEPS = 0.75, 0.02, 8
#: Rows that a group's parent counts for in its estimates.
PRIOR = 50
#: The median of chi-squared with five degrees of freedom. Statistics of clean texts are far from normal (short ones with a
#: repeated line, say), so the limit is Tukey's fence on the logarithms of all distances: Q3 + FENCE * (Q3 - Q1).
CHI2_MEDIAN, FENCE = 4.351, 1.5
#: Tables of estimates go to every task only if they have at most this many rows.
BROADCAST_ROWS = 20_000
STATS = ["log_words", "word_length", "symbols", "dup_lines", "repeats"]
#: Standard deviations in a group count as at least this, so that a statistic that is constant in the core gives no zero variance.
FLOORS = {"log_words": 0.5, "word_length": 0.35, "symbols": 0.05, "dup_lines": 0.1, "repeats": 0.1}


def word_statistics(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed (see quality_rules)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    w, h, at, lines = (free_name(docs, s) for s in ("_words", "_windows", "_places", "_lines"))
    plain = trimmed(F.col("text"))
    split = F.when(F.length(plain) == 0, F.array().cast("array<string>")).otherwise(F.split(plain, SPACES))
    with_words = docs.withColumn(w, split).withColumn(lines, F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0))
    # windows with their places, sorted, so that windows found twice or more are neighbours; none if all differ
    with_windows = with_words.withColumn(h, word_windows(F.col(w), 3))
    placed = F.array_sort(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    with_places = with_windows.withColumn(at, F.when(F.size(F.array_distinct(h)) < F.size(h), placed))
    again = F.filter(F.col(at), lambda x, i: (x["h"] == F.get(F.col(at), i - 1)["h"]) | (x["h"] == F.get(F.col(at), i + 1)["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    repeats = F.when(F.col(at).isNull(), 0).otherwise(covered)
    out = with_places.select(
        *docs.columns,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _transformed() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words").alias("log_words"),
        (F.col("word_chars") / n).alias("word_length"),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") / n).alias("dup_lines"),
        F.sqrt(F.col("n_repeat_words") / n).alias("repeats"),
    ]


def _inverse(matrix: Column) -> Column:
    """The inverse of a positive definite matrix (an array of rows) by Gauss-Jordan steps."""

    def step(a: Column, k: Column) -> Column:
        pivot_row = F.get(a, k)
        pivot = F.get(pivot_row, k)

        def cell(row: Column, i: Column, v: Column, j: Column) -> Column:
            own = F.when(i == k, F.when(j == k, 1 / pivot).otherwise(v / pivot))
            return own.when(j == k, -v / pivot).otherwise(v - F.get(row, k) * F.get(pivot_row, j) / pivot)

        return F.transform(a, lambda row, i: F.transform(row, lambda v, j: cell(row, i, v, j)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(STATS) - 1)), matrix, step)


#: A unit of estimation: a (lang, source) group at level 0, a language at level 1, all rows at level 2.
UNIT = ["level", "lang", "source"]


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _moments(rows: DataFrame) -> DataFrame:
    """Per unit the number of rows, the mean and the covariances (the lower triangle, row by row)."""
    p = range(len(STATS))
    means, pairs = [F.avg(s).alias(f"m{i}") for i, s in enumerate(STATS)], [(i, j) for i in p for j in range(i + 1)]
    sums = rows.groupBy(*UNIT).agg(F.count("*").alias("n"), *means, *(F.covar_pop(STATS[i], STATS[j]).alias(f"c{i}{j}") for i, j in pairs))
    return sums.select(*UNIT, "n", F.array(*(f"m{i}" for i in p)).alias("mean"), F.array(*(f"c{i}{j}" for i, j in pairs)).alias("cov"))


def _drawn(moments: DataFrame) -> DataFrame:
    """Per unit the mean and the inverse covariance (`metric`) with the weight of its parents."""

    def towards(own: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
        mix = lambda a, b: F.zip_with(a, b, lambda x, y: (x * F.col("n") + y * PRIOR) / (F.col("n") + PRIOR))
        above = _small(parents.select(*on, F.col("mean").alias("_mean"), F.col("cov").alias("_cov")))
        return own.join(above, on).select(*UNIT, "n", mix("mean", "_mean").alias("mean"), mix("cov", "_cov").alias("cov"))

    every = moments.where("level = 2")
    langs = towards(moments.where("level = 1").withColumn("_one", F.lit(1)), every.withColumn("_one", F.lit(1)), ["_one"])
    out = every.select(*UNIT, "n", "mean", "cov").union(langs).union(towards(moments.where("level = 0"), langs, ["lang"]))
    p = range(len(STATS))
    at = lambda i, j: F.get("cov", F.lit(max(i, j) * (max(i, j) + 1) // 2 + min(i, j)))
    matrix = F.array(*(F.array(*(at(i, j) + (FLOORS[STATS[i]] ** 2 if i == j else 0.0) for j in p)) for i in p))
    return out.select(*UNIT, "n", "mean", _inverse(matrix).alias("metric"))


def _distances(rows: DataFrame, metrics: DataFrame) -> DataFrame:
    """rows with d2, the squared Mahalanobis distance in their unit's metric."""
    far = [F.col(s) - F.get("mean", F.lit(i)) for i, s in enumerate(STATS)]
    terms = [far[i] * far[j] * F.get(F.get("metric", F.lit(i)), F.lit(j)) for i in range(len(STATS)) for j in range(len(STATS))]
    return rows.join(_small(metrics.select(*UNIT, "mean", "metric")), UNIT).select(*rows.columns, sum(terms[1:], terms[0]).alias("d2"))


def _first_moments(rows: DataFrame) -> DataFrame:
    """Medians, and median absolute deviations as the only variances."""
    p = range(len(STATS))
    middle = rows.groupBy(*UNIT).agg(F.count("*").alias("n"), *(F.percentile_approx(s, 0.5, 10000).alias(f"m{i}") for i, s in enumerate(STATS)))
    away = rows.join(_small(middle), UNIT).groupBy(*UNIT).agg(*(F.percentile_approx(F.abs(F.col(s) - F.col(f"m{i}")), 0.5, 10000).alias(f"a{i}") for i, s in enumerate(STATS)))
    width = [F.pow(1.4826 * F.col(f"a{i}"), 2) for i in p]
    cov = F.array(*(width[i] if i == j else F.lit(0.0) for i in p for j in range(i + 1)))
    return middle.join(away, UNIT).select(*UNIT, "n", F.array(*(f"m{i}" for i in p)).alias("mean"), cov.alias("cov"))


def _moved(old: DataFrame, new: DataFrame) -> float | None:
    """The largest move of a covariance between two sets of estimates, in units of the floors."""
    pairs = [(i, j) for i in range(len(STATS)) for j in range(i + 1)]
    units = F.array(*(F.lit(FLOORS[STATS[i]] * FLOORS[STATS[j]]) for i, j in pairs))
    both = old.select(*UNIT, F.col("cov").alias("was")).join(new, UNIT)
    moves = F.zip_with(F.zip_with("cov", "was", lambda x, y: F.abs(x - y)), units, lambda x, u: x / u)
    return both.agg(F.max(F.array_max(moves))).first()[0]


def quality_rules(docs: DataFrame) -> DataFrame:
    """Returns (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance), a row for
    each row of docs.

    Words are runs of characters other than ASCII white space; word_chars counts their code points; n_symbols counts
    characters of SYMBOLS; n_dup_lines counts lines (split at \\n, with a word) that equal an earlier one; n_repeat_words
    counts words in 3-word windows found twice or more in the text, windows being compared by 64-bit hashes. base_failed:
    fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT of them repeated. kept: not base_failed and no outlier of its
    (lang, source) group; `distance` is the scaled squared distance, null if base_failed. Null and empty texts have no words.
    A null lang or source is a value like others. Repeated rows each count; rows with equal distances are kept or rejected
    together. A very long text is one row of one task, as are its windows. An empty table stays empty. Estimates that have not
    settled after STEPS steps give a RuntimeWarning.
    """
    named = docs.select("doc_id", "text", *(F.coalesce(F.col(c), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in ("lang", "source")))
    rows = stored(word_statistics(named).drop("text").select("*", *_transformed()), "stats")
    good = rows.where("not base_failed")
    none = F.lit("")
    units = F.array(*(F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source")) for k, (lang, source) in enumerate(((F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)))))
    wide = stored(good.select(F.explode(units).alias("u"), *STATS).select("u.*", *STATS), "units")

    moments = stored(_first_moments(wide), "moments")
    for _ in range(STEPS):
        near = _distances(wide, stored(_drawn(moments), "metrics"))
        limit = near.groupBy(*UNIT).agg(F.percentile_approx("d2", CORE, 10000).alias("most"))
        before, moments = moments, stored(_moments(near.join(_small(stored(limit, "limits")), UNIT).where("d2 <= most")), "moments")
        if (move := _moved(before, moments) or 0.0) <= STILL:
            break
    else:
        warnings.warn(f"estimates still move by {move:.3g} floors after {STEPS} concentration steps", RuntimeWarning, stacklevel=2)
    metrics = stored(_drawn(moments), "metrics")
    middle = stored(_distances(wide, metrics).groupBy(*UNIT).agg(F.count("*").alias("n"), F.percentile_approx("d2", 0.5, 10000).alias("median")), "middles")
    langs = middle.where("level = 1").select("lang", F.col("median").alias("_median"))
    scale = middle.where("level = 0").join(langs, "lang").select("lang", "source", ((F.col("median") * F.col("n") + F.col("_median") * PRIOR) / (F.col("n") + PRIOR)).alias("median"))

    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _distances(good.withColumn("level", F.lit(0)), metrics).join(_small(scale), ["lang", "source"])
    judged = stored(judged.select(*columns, (F.col("d2") * CHI2_MEDIAN / F.greatest("median", F.lit(1e-9))).alias("distance")), "distances")
    quarters = judged.agg(F.percentile_approx(F.log(F.greatest("distance", F.lit(1e-9))), [0.25, 0.75], 10000)).first()[0] or [0.0, 0.0]
    most = math.exp(quarters[1] + FENCE * (quarters[1] - quarters[0]))
    judged = judged.select(*columns, (F.col("distance") <= most).alias("kept"), "distance")
    return judged.union(rows.where("base_failed").select(*columns, F.lit(False), F.lit(None).cast("double")))
