"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters between words, for Java's regular expressions: space, and tab to return.
BLANK = r"[ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words between blanks, unchanged; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK + "+"))


def shingle_hashes(words: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` consecutive words, in their order."""
    return F.when(
        F.size(words) >= size,
        F.transform(F.sequence(F.lit(0), F.size(words) - size),
                    lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    ).otherwise(F.array().cast("array<bigint>"))
