"""Waiting for a cluster or a restored index, as a stream of health samples.

What matters about a wait is its last sample and its first ready one, a maximum and a
minimum. So each micro-batch reduces its own samples to one row per wait and puts them into a
table, and reading the table merges the rows. Nothing is held between batches: samples may come
in any order and arbitrarily late, none is dropped, and no state grows in the stream.

Table and progress are folders that the caller names: with the same two a stream that was stopped
or failed goes on where it was. A batch that runs again replaces its own folder. As rows merge by
maximum and minimum, a row that is there twice, before and after compaction, changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from ..operators.status import health_ready


def _spans(judged: DataFrame, keys: list[str]) -> DataFrame:
    return judged.groupBy(*keys, "started").agg(
        F.max("ts").alias("last_sample"),
        F.min(F.when(F.col("cluster_ready"), F.col("ts"))).alias("ready_at"))


def _schema(samples: DataFrame, keys: list[str]) -> StructType:
    schema = samples.select(*keys, "started").schema
    for name in ("last_sample", "ready_at"):
        schema = schema.add(name, TimestampType())
    return schema


def _folders(spark: SparkSession, table: str) -> dict[str, object]:
    """The folders of a table by name; the driver sees one name per batch since the last compaction."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return {}
    return {s.getPath().getName(): s.getPath() for s in system.listStatus(path) if s.isDirectory()}


def drain(samples: DataFrame, keys: list[str], expected_nodes: Column, table: str, progress: str) -> DataFrame:
    """Run a stream of samples over what is available now, and read the ``table``: one row per wait and batch.

    ``samples`` is a stream of keys + (started, ts, content): when the wait began, when
    the sample was taken, and the health reply. ``progress`` is the stream's checkpoint; a later call with
    the same folders reads only samples that no finished batch has."""
    spark = samples.sparkSession

    def put(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch: a batch that runs again replaces its own rows
        _spans(health_ready(batch, expected_nodes), keys).write.mode("overwrite").parquet(
            f"{table}/batch={batch_id}")

    (samples.writeStream.foreachBatch(put).option("checkpointLocation", progress)
     .trigger(availableNow=True).start().awaitTermination())
    return read_spans(spark, table, _schema(samples, keys))


def read_spans(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows of all batches so far; none if there has been no batch."""
    if not _folders(spark, table):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(table)


def compact(spark: SparkSession, table: str, keys: list[str], schema: StructType) -> DataFrame:
    """Merge the folders of all batches into one with a row per wait, and read the table. To be run between
    runs of the stream. The new folder is complete before the old ones go, so a run that is lost on its
    way leaves rows twice, and no wait without its rows."""
    old = _folders(spark, table)
    if len(old) > 1:
        merged = read_spans(spark, table, schema).groupBy(*keys, "started").agg(
            F.max("last_sample").alias("last_sample"), F.min("ready_at").alias("ready_at"))
        number = 1 + max((int(n.partition("=")[2]) for n in old if n.startswith("merged=")), default=-1)
        merged.write.mode("overwrite").parquet(f"{table}/merged={number}")
        for path in old.values():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return read_spans(spark, table, schema)


def watch_health(spans: DataFrame, keys: list[str], timeout_s: int,
                 as_of: Column | None = None) -> DataFrame:
    """Outcome of each wait from the rows of all batches so far.

    A wait is over time once it, or the clock ``as_of`` if one is given, is past its deadline;
    without a clock a wait that gets no further sample stays open."""
    merged = spans.groupBy(*keys, "started").agg(
        F.max("last_sample").alias("last_sample"), F.min("ready_at").alias("ready_at"))
    deadline = F.col("started") + F.expr(f"INTERVAL {int(timeout_s)} SECONDS")
    seen = F.col("last_sample") if as_of is None else F.greatest("last_sample", as_of)
    return merged.withColumn(
        "outcome",
        F.when(F.col("ready_at") <= deadline, F.lit("ready"))
        .when(seen >= deadline, F.lit("timeout"))
        .otherwise(F.lit("waiting")))
