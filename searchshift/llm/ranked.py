"""Places of rows inside their groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_parents
from ..session import materialized

#: Rows of a table that is sent to every task, at most.
MOST_SENT = 50_000


def with_parents(rows: DataFrame, parents: DataFrame, keys: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the one narrow row of ``parents`` for their keys: sent to every task if it
    is counted to be small, or else joined on salted keys."""
    if parents.count() <= MOST_SENT:
        return rows.join(F.broadcast(parents), keys, how)
    return join_parents(rows, parents, keys, spread, how)


def places(df: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """``df`` with ``place``, the 0-based place of each row in its group by ``order``, and ``size``,
    the number of rows of the group. ``group`` must not be null; ``df`` should be cheap to read twice.

    Rows are range-sorted by group and order and written down, so a group of any size is cut
    into ranges. Rows that are equal in the order are parted by where they came from. What meets
    in one task is a count for each range that holds rows of one group."""
    sort = [F.col(group), *order, F.col("_came")]
    sorted_rows = (df.withColumn("_came", F.monotonically_increasing_id()).repartitionByRange(*sort)
                   .sortWithinPartitions(*sort).drop("_came").withColumn("_at", F.monotonically_increasing_id()))
    written = materialized(sorted_rows, label).withColumn("_range", F.shiftright("_at", 33))
    runs = written.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialized(runs.select(
        group, "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("size")), f"{label}-starts")
    return (with_parents(written, starts, [group, "_range"], ["_at"])
            .withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift"))
