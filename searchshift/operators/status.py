"""Cluster status replies, stored as JSON text in a ``content`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUS = """
cluster struct<
  live_nodes: array<string>,
  collections: map<string, struct<
    replicationFactor: string,
    shards: map<string, struct<
      replicas: map<string, struct<leader: string, node_name: string>>>>>>>
"""


NODES = "cluster struct<live_nodes: array<string>>"


def _parsed(status: DataFrame, schema: str) -> DataFrame:
    return status.withColumn("_status", F.from_json("content", schema))


def shard_leaders(status: DataFrame, keys: list[str]) -> DataFrame:
    """One row per shard: collection size and replication factor, replica count and
    leader node; ``?`` where there is none."""
    collections = _parsed(status, STATUS).select(
        *keys, F.explode("_status.cluster.collections").alias("collection", "_collection"))
    # sizes come first, so that no shard's row carries the whole collection
    sized = collections.select(
        *keys, "collection",
        F.coalesce(F.size("_collection.shards"), F.lit(0)).alias("shard_count"),
        F.coalesce("_collection.replicationFactor", F.lit("?")).alias("replication_factor"),
        F.col("_collection.shards").alias("_shards"))
    shards = sized.select(*keys, "collection", "shard_count", "replication_factor",
                          F.explode("_shards").alias("shard", "_shard"))
    replicas = F.map_values("_shard.replicas")
    leader = F.get(F.filter(replicas, lambda r: r["leader"] == "true"), 0)["node_name"]
    return shards.select(
        *keys, "collection", "shard_count", "replication_factor", "shard",
        F.greatest(F.coalesce(F.size("_shard.replicas"), F.lit(0)), F.lit(0)).alias("replicas"),
        F.coalesce(leader, F.lit("?")).alias("leader_node"))


def live_nodes(status: DataFrame, keys: list[str]) -> DataFrame:
    """Live nodes of each cluster with their place in name order."""
    return _parsed(status, NODES).select(
        *keys, F.posexplode(F.array_sort("_status.cluster.live_nodes")).alias("position", "node"))


def nodes_ready(status: DataFrame, keys: list[str], expected: Column) -> DataFrame:
    """Whether the number of live nodes has reached the expected one."""
    count = F.greatest(F.coalesce(F.size("_status.cluster.live_nodes"), F.lit(0)), F.lit(0))
    return _parsed(status, NODES).select(*keys, count.alias("nodes"), expected.alias("expected_nodes"),
                                  (count >= expected).alias("ready"))


def health_ready(samples: DataFrame, expected_nodes: Column) -> DataFrame:
    """Readiness in each stored health reply: the cluster is ready with enough nodes
    and green, an index is done when green. Unreadable replies count as red."""
    health = F.from_json("content", "number_of_nodes int, status string")
    return (
        samples.withColumn("_health", health)
        .withColumn("nodes", F.coalesce("_health.number_of_nodes", F.lit(0)))
        .withColumn("status", F.coalesce("_health.status", F.lit("red")))
        .withColumn("cluster_ready", (F.col("nodes") >= expected_nodes)
                    & (F.col("status") == "green"))
        .withColumn("restore_state", F.when(F.col("status") == "green", F.lit("done"))
                    .otherwise(F.lit("waiting")))
        .drop("_health")
    )


def wait_outcome(samples: DataFrame, keys: list[str], time: str, ready: Column,
                 timeout_s: int) -> DataFrame:
    """Outcome of waiting for readiness over a series of samples: ready at the first
    ready sample within the timeout, timed out once samples go past it, else still
    waiting. Works on a batch and, in update mode, on a stream."""
    spans = samples.groupBy(*keys).agg(
        F.min(time).alias("started"), F.max(time).alias("last_sample"),
        F.min(F.when(ready, F.col(time))).alias("ready_at"))
    deadline = F.col("started") + F.expr(f"INTERVAL {int(timeout_s)} SECONDS")
    return spans.withColumn(
        "outcome",
        F.when(F.col("ready_at") <= deadline, F.lit("ready"))
        .when(F.col("last_sample") >= deadline, F.lit("timeout"))
        .otherwise(F.lit("waiting")))
