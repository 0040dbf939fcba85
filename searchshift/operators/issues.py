"""Issue rows: (backup_id, severity, code, subject, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

COLUMNS = ["backup_id", "severity", "code", "subject", "detail"]


def issue(code: str, subject: Column, detail: Column) -> Column:
    """One issue as a struct, for use in arrays of conditional issues."""
    return F.struct(
        F.lit(rules.SEVERITY[code]).alias("severity"),
        F.lit(code).alias("code"),
        subject.cast("string").alias("subject"),
        detail.cast("string").alias("detail"),
    )


def when(condition: Column, code: str, subject: Column, detail: Column) -> Column:
    return F.when(condition, issue(code, subject, detail))


def emit(df: DataFrame, *candidates: Column) -> DataFrame:
    """One row per candidate that applies; a row may raise several issues."""
    found = F.explode(F.array_compact(F.array(*candidates)))
    return df.select("backup_id", found.alias("issue")).select("backup_id", "issue.*")


def issue_rows(df: DataFrame, code: str, subject: Column, detail: Column) -> DataFrame:
    """Every row of the input as an issue of one kind."""
    return df.select("backup_id", issue(code, subject, detail).alias("issue")).select(
        "backup_id", "issue.*")


def union_issues(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
