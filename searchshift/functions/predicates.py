"""Search predicates as boolean columns that stay inside generated code."""

from __future__ import annotations

import datetime as dt
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def query_tokens(query: str) -> list[str]:
    """Lower-cased runs of letters and digits, first occurrence of each."""
    spaced = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in query.lower())
    return list(dict.fromkeys(spaced.split()))


def has_token(column: Column, token: str) -> Column:
    """True where the analysed text contains the token.

    A plain substring test goes first: it rejects most rows at a fraction of the
    cost of the boundary check, and neither builds an array of tokens per row.
    """
    text = F.lower(column)
    bounded = rf"(?<![\p{{L}}\p{{N}}]){token}(?![\p{{L}}\p{{N}}])"
    return text.contains(token) & text.rlike(bounded)


def match_text(column: Column, query: str, operator: str = "or") -> Column:
    """Full-text match of any (``or``) or all (``and``) tokens of the query."""
    if operator not in ("or", "and"):
        raise ValueError(f"operator must be 'or' or 'and', not {operator!r}")
    tests = [has_token(column, token) for token in query_tokens(query)]
    if not tests:
        return F.lit(False)
    return reduce((lambda a, b: a | b) if operator == "or" else (lambda a, b: a & b), tests)


def term(column: Column, value) -> Column:
    return column == F.lit(value)


def range_filter(column: Column, *, gte=None, gt=None, lte=None, lt=None) -> Column:
    """Conjunction of the given bounds."""
    tests = []
    if gte is not None:
        tests.append(column >= F.lit(gte))
    if gt is not None:
        tests.append(column > F.lit(gt))
    if lte is not None:
        tests.append(column <= F.lit(lte))
    if lt is not None:
        tests.append(column < F.lit(lt))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def date_range(df: DataFrame, name: str, *, gte: str | None = None, gt: str | None = None,
               lte: str | None = None, lt: str | None = None) -> Column:
    """Range with day-precision bounds. An upper ``lte`` day counts whole, and so a
    ``gt`` day is excluded whole. Bounds take the column's own type, so the filter
    reaches the scan."""
    kind = df.schema[name].dataType.simpleString()

    def instant(day: str, add: int) -> Column:
        moved = dt.date.fromisoformat(day) + dt.timedelta(days=add)
        return F.lit(moved.isoformat()).cast(kind)

    column = F.col(name)
    tests = []
    if gte is not None:
        tests.append(column >= instant(gte, 0))
    if gt is not None:
        tests.append(column >= instant(gt, 1))
    if lte is not None:
        tests.append(column < instant(lte, 1))
    if lt is not None:
        tests.append(column < instant(lt, 0))
    return reduce(lambda a, b: a & b, tests, F.lit(True))
