"""Replication factor from stored collection states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_int(text: Column) -> Column:
    """Integer value of a JSON scalar as text; fractions are cut, other text is -1."""
    number = text.try_cast("double")
    return F.coalesce(number.try_cast("int"), F.lit(-1))


def collection_state(states: DataFrame) -> DataFrame:
    """Replication factor of the first collection in each backup's state.

    ``states`` is (backup_id, dir_rank, content), one row per candidate file. The first
    file whose first collection has the entry decides; text that is not JSON, or holds
    no entry, leaves it to the next file. Unknown is -1."""
    parsed = F.from_json("content", "map<string, map<string, string>>")
    first = F.get(F.map_values(parsed), 0)
    has_entry = F.map_contains_key(first, "replicationFactor")
    factor = _as_int(F.try_element_at(first, F.lit("replicationFactor")))
    known = states.select(
        "backup_id", "dir_rank",
        F.when(has_entry, factor).alias("factor"))
    # rank and factor travel as one number: the lowest rank with an entry wins
    packed = F.min(F.when(F.col("factor").isNotNull(),
                          F.col("dir_rank").cast("bigint") * 2 ** 32
                          + F.col("factor").cast("bigint") + 2 ** 31))
    return known.groupBy("backup_id").agg(packed.alias("_best")).select(
        "backup_id",
        F.coalesce((F.pmod(F.col("_best"), F.lit(2 ** 32)) - 2 ** 31).cast("int"), F.lit(-1))
        .alias("replication_factor"))
