"""Row numbers and running totals that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized

BLOCK_BITS = 10


def number_rows(df: DataFrame, order_cols: list[str], name: str = "row_index") -> DataFrame:
    """Dense 0-based numbering over the whole input in the given order; rows that are
    equal in it keep their order in the input.

    The input is range-sorted once and written down, since the positions inside a
    partition and the partition sizes must come from the same run. The place in the
    input takes part in the sort, so a value that most rows share is cut into several
    ranges too. Only one count per partition meets in a single task.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    positioned = materialized(
        placed.orderBy(*order_cols, "_place").drop("_place")
        .withColumn("_position", F.monotonically_increasing_id()), "numbered")
    partition = F.shiftright("_position", 33)
    sizes = positioned.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        positioned.withColumn("_partition", partition)
        # one row per sort partition, however large the data
        .join(F.broadcast(starts), "_partition")
        .withColumn(name, F.col("_start") + F.col("_position").bitwiseAND((1 << 33) - 1))
        .drop("_partition", "_position", "_start")
    )


def running_total(df: DataFrame, keys: list[str], order: str, value: str, before: str,
                  total: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group, by a unique integer
    order column, and over the whole group.

    Rows are summed in blocks of consecutive order values first, so that the window
    over a group holds one row per block and the window over rows is bounded by the
    block.
    """
    rows = df.withColumn("_block", F.shiftright(order, BLOCK_BITS))
    sums = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_block",
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
                         F.sum("_sum").over(group).alias(total))
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        rows.join(starts, [*keys, "_block"])
        .withColumn(before, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_block", "_start")
    )
