"""Verification queries on a restored index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import match_text, term


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition).agg(F.count("*").alias("count"))


def metric_aggs(df: DataFrame, metrics: dict[str, tuple[str, str]]) -> DataFrame:
    """Several metrics in one pass: result name -> (function, column). Missing values
    are ignored."""
    functions = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    return df.agg(*[functions[f](c).alias(n) for n, (f, c) in metrics.items()])


def docs_per_shard(copies: DataFrame) -> DataFrame:
    """Documents by shard and copy kind (primary or replica), sorted."""
    return copies.groupBy("shard", "prirep").agg(
        F.sum("docs").alias("docs"), F.count("*").alias("copies")).orderBy("shard", "prirep")


def first_hits(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """The first n hits of a match-all query, by key."""
    return df.orderBy(key).limit(n)


def field_predicate(column: Column, value, target: str, predicate: str) -> Column:
    """A ``match`` or ``term`` test as the target engine answers it.

    A term is compared as it stands: with the whole value of other fields, but with the
    analysed tokens of a text field, which are lower case."""
    if target != "text":
        return term(column, value)
    if predicate == "match":
        return match_text(column, value)
    tokens = F.split(F.lower(column), r"[^\p{L}\p{N}]+")
    return F.lit(value != "") & F.array_contains(tokens, value)


def field_query(df: DataFrame, expression: str, target_types: dict[str, str]) -> DataFrame:
    """Rows for ``field:value`` or ``*:*``. Text fields are matched by token, others
    exactly under their type; an undeclared field finds nothing."""
    if expression == "*:*":
        return df
    field, _, value = expression.partition(":")
    target = target_types.get(field)
    if target is None:
        return df.filter(F.lit(False))
    if target == "text":
        return df.filter(field_predicate(F.col(field), value, target, "match"))
    kind = df.schema[field].dataType.simpleString()
    return df.filter(F.col(field) == F.lit(value).try_cast(kind))
