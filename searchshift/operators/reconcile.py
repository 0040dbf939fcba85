"""Comparison of source and target.

Both sides are stacked and aggregated instead of joined, so repeated or missing keys
never multiply rows and a key with most of the rows is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stack(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.withColumn("_source", F.lit(1).cast("bigint")).withColumn(
        "_target", F.lit(0).cast("bigint")
    ).unionByName(
        target.withColumn("_source", F.lit(0).cast("bigint"))
        .withColumn("_target", F.lit(1).cast("bigint")))


def _row_hash(columns: list[str]) -> Column:
    """Hash of a row's values; which of them are NULL is part of it."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*[F.col(c) for c in columns], *nulls)


def reconcile_counts(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per collection on both sides; equal only if exactly the same."""
    counts = _stack(source.select(*keys), target.select(*keys)).groupBy(*keys).agg(
        F.sum("_source").alias("source_count"), F.sum("_target").alias("target_count"))
    return counts.withColumn(
        "status", F.when(F.col("source_count") == F.col("target_count"), F.lit("OK"))
        .otherwise(F.lit("MISMATCH")))


def reconcile_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ: missing in the target, extra in it, or changed.

    Repeated keys are compared as bags of rows: the row hashes of the source are added
    up and those of the target taken off, so one aggregation by key decides."""
    values = [c for c in source.columns if c not in keys]
    both = _stack(source.select(*keys, *values), target.select(*keys, *values))
    share = _row_hash(values).cast("decimal(20,0)")
    compared = both.select(
        *keys, "_source", "_target",
        F.when(F.col("_source") == 1, share).otherwise(-share).alias("_share")
    ).groupBy(*keys).agg(
        F.sum("_source").alias("source_rows"), F.sum("_target").alias("target_rows"),
        F.sum("_share").alias("_difference"))
    return compared.filter(
        (F.col("source_rows") != F.col("target_rows")) | (F.col("_difference") != 0)
    ).select(
        *keys, "source_rows", "target_rows",
        F.when(F.col("target_rows") == 0, F.lit("missing"))
        .when(F.col("source_rows") == 0, F.lit("extra"))
        .otherwise(F.lit("changed")).alias("status"))


def reconcile_bags(source: DataFrame, target: DataFrame) -> DataFrame:
    """For data without a key: rows that occur a different number of times."""
    columns = source.columns
    return (
        _stack(source, target.select(*columns)).groupBy(*columns)
        .agg(F.sum("_source").alias("source_rows"), F.sum("_target").alias("target_rows"))
        .filter(F.col("source_rows") != F.col("target_rows"))
    )


def reconcile_schema(source: DataFrame, target: DataFrame) -> DataFrame:
    """Field lists compared: inputs are (backup_id, field, target_type), one row per
    field and side."""
    keys = ["backup_id", "field"]
    both = source.select(*keys, F.col("target_type").alias("source_type"),
                         F.lit(None).cast("string").alias("restored_type")).unionByName(
        target.select(*keys, F.lit(None).cast("string").alias("source_type"),
                      F.col("target_type").alias("restored_type")))
    merged = both.groupBy(*keys).agg(F.max("source_type").alias("source_type"),
                                     F.max("restored_type").alias("restored_type"))
    return merged.withColumn(
        "status",
        F.when(F.col("restored_type").isNull(), F.lit("missing"))
        .when(F.col("source_type").isNull(), F.lit("extra"))
        .when(F.col("source_type") != F.col("restored_type"), F.lit("retyped"))
        .otherwise(F.lit("same")))


def replica_check(settings: DataFrame) -> DataFrame:
    """Settings and health of each restored index against its source.

    ``settings`` is (backup_id, shard_count, replication_factor, settings, health) with
    the target engine's JSON replies."""
    health = F.from_json("health", "status string, active_primary_shards int, active_shards int")
    actual = F.get_json_object("settings", "$.index.number_of_replicas").try_cast("int")
    expected = F.col("replication_factor") - 1
    total = F.col("shard_count") * F.col("replication_factor")
    return (
        settings.withColumn("_health", health)
        .select(
            "backup_id", expected.alias("expected_replicas"), actual.alias("actual_replicas"),
            F.col("shard_count").alias("expected_primaries"),
            F.col("_health.active_primary_shards").alias("actual_primaries"),
            total.alias("expected_shards"), F.col("_health.active_shards").alias("actual_shards"),
            F.col("_health.status").alias("health"))
        .withColumn("passed", F.coalesce(
            (F.col("actual_replicas") == F.col("expected_replicas"))
            & (F.col("actual_primaries") == F.col("expected_primaries"))
            & (F.col("actual_shards") == F.col("expected_shards"))
            & (F.col("health") == "green"), F.lit(False)))
    )


def dataset_stats(df: DataFrame, order: str, amount: Column, measure: Column, when: str,
                  groups: list[str]) -> DataFrame:
    """Records, sum, average and the first and last date by record order: one line for
    everything (NULL group) and one per value of each group column.

    Grouping sets over the group columns give all lines in one pass."""
    amounts = df.select(F.col(order).alias("_order"), amount.alias("_amount"),
                        measure.alias("_measure"), F.col(when).alias("_when"), *groups)
    sets = [[], *[[F.col(g)] for g in groups]]
    lines = amounts.groupingSets(sets, *[F.col(g) for g in groups]).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("records"), F.sum("_amount").alias("total"),
        F.avg("_measure").alias("average"),
        F.min_by("_when", "_order").alias("first_date"),
        F.max_by("_when", "_order").alias("last_date"))
    everything = 2 ** len(groups) - 1
    dimension = F.when(F.col("_set") == everything, F.lit("all"))
    for i, g in enumerate(groups):
        dimension = dimension.when(
            F.col("_set") == everything - 2 ** (len(groups) - 1 - i), F.lit(g))
    return lines.select(
        dimension.alias("dimension"), F.coalesce(*[F.col(g).cast("string") for g in groups])
        .alias("value"), "records", "total", "average", "first_date", "last_date")


def check_results(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Named aggregate expressions evaluated in one pass, as rows (check, value)."""
    measured = df.agg(*[c.cast("double").alias(n) for n, c in checks.items()])
    lines = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("value")) for n in checks])
    return measured.select(F.explode(lines).alias("line")).select("line.*")


def expected_matrix(results: DataFrame, expectations: DataFrame) -> DataFrame:
    """Results (check, value) against expectations (check, value), pass or fail.

    An expectation without a value asks only for a number."""
    joined = expectations.withColumnRenamed("value", "expected").join(
        results.withColumnRenamed("value", "actual"), "check", "left")
    return joined.withColumn(
        "passed",
        F.when(F.col("expected").isNull(), F.col("actual").isNotNull())
        .otherwise(F.coalesce(F.col("actual") == F.col("expected"), F.lit(False))))
