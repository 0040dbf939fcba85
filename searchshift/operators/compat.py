"""Which source indexes a target release can read, and what has been tested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import version_part


def _targets(df: DataFrame, targets=rules.TARGETS) -> Column:
    """Target releases as an array of structs; a fixed list."""
    rows = [F.struct(F.lit(v).alias("target_version"), F.lit(library).alias("target_library"),
                     F.lit(int(library.split(".")[0])).alias("target_major"))
            for v, library in targets]
    return F.array(*rows)


def compatible_versions(sources: DataFrame, targets=rules.TARGETS,
                        converter_major: int = rules.CONVERTER_MAJOR) -> DataFrame:
    """Verdict for every source index version and target release.

    A target reads its own library major and the one before; the converter's own
    library has the same limit. ``sources`` carries ``lucene_version``; it is reduced
    to distinct versions before meeting the fixed list of targets."""
    versions = sources.filter(F.col("lucene_version").isNotNull()).groupBy("lucene_version").agg(
        F.count("*").alias("indexes"))
    pairs = versions.select(
        "lucene_version", "indexes", F.explode(_targets(versions, targets)).alias("t")
    ).select("lucene_version", "indexes", "t.*")
    major = version_part(F.col("lucene_version"), 0)
    readable = (F.col("target_major") - major).between(0, 1)
    convertible = (F.lit(converter_major) - major).between(0, 1)
    return pairs.withColumn("target_reads", readable).withColumn(
        "converter_reads", convertible
    ).withColumn(
        "compatible",
        F.when(readable & convertible, F.lit("YES")).when(readable, F.lit("MAYBE"))
        .otherwise(F.lit("NO")))


def matrix_status(compatibility: DataFrame, tested=rules.TESTED) -> DataFrame:
    """Matrix of source by target with the test outcome: the outcome if tested, N/A if
    not compatible, else open."""
    outcome = F.lit(None).cast("string")
    for library, target, result in tested:
        outcome = F.when((F.col("lucene_version") == library)
                         & (F.col("target_version") == target), F.lit(result)).otherwise(outcome)
    return compatibility.withColumn("_outcome", outcome).select(
        "lucene_version", "target_version", "target_library", "indexes", "compatible",
        F.when(F.col("_outcome").isNotNull(), F.lit("YES")).otherwise(F.lit("NO")).alias("tested"),
        F.coalesce("_outcome", F.when(F.col("compatible") == "NO", F.lit("N/A"))
                   .otherwise(F.lit("-"))).alias("status"))


def matrix_counts(matrix: DataFrame) -> DataFrame:
    """Source versions and indexes by status."""
    return matrix.groupBy("status").agg(
        F.count("*").alias("pairs"), F.sum("indexes").alias("indexes"))


def matrix_pivot(matrix: DataFrame, targets=rules.TARGETS) -> DataFrame:
    """The matrix with one column per target release."""
    return matrix.groupBy("lucene_version").pivot(
        "target_version", [v for v, _ in targets]).agg(F.first("status"))
