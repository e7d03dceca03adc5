"""Text helpers made of built-in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space and letters.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))


def lowered(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null and empty texts."""
    t = trimmed(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, SPACES))


def positions(n: Column) -> Column:
    """0, 1, ... n - 1; empty if n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def word_windows(words: Column, size: int) -> Column:
    """64-bit hashes of all windows of `size` words in order."""
    return F.transform(positions(F.size(words) - (size - 1)), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
