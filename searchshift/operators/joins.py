"""Joining many rows to the one row of their group, and tables that grow with the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def join_parents(rows: DataFrame, parents: DataFrame, keys: list[str], spread: list[str],
                 how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join where a single key may hold a third of ``rows`` and ``parents`` has one
    narrow row per key.

    Rows of a key are dealt out over ``salts`` places by the ``spread`` columns, which
    tell them apart, and each parent is present in every place. The salt also parts the
    join from the aggregation that made the parents: where both use the same
    partitioning, adaptive execution cannot split a hot partition any further.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = parents.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")


def join_shuffled(rows: DataFrame, others: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a table that grows with the job and must not be sent to all tasks: the size
    of a compressed listing, or of what a row becomes when it is multiplied, says little about
    the memory that its rows take, and a broadcast goes through the driver."""
    return rows.join(others.hint("merge"), keys, how)


def join_groups(rows: DataFrame, parents: DataFrame, keys: list[str], spread: list[str],
                how: str = "inner") -> DataFrame:
    """``join_parents`` where most groups have a few rows only, so that copies of the parents
    would outnumber the rows: each parent comes once, through the shuffle. Adaptive execution
    still splits the rows of a hot key, as the join has a partitioning of its own."""
    return join_parents(rows, parents.hint("merge"), keys, spread, how, salts=1)
