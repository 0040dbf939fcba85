"""Waiting for readiness over a stream of samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..streaming.watch import drain, watch_health
from .catalog import query

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("watch_health", """
WITH samples AS (
  SELECT 'i' || CAST(user_id AS VARCHAR) AS index_name, date_trunc('day', ts)::TIMESTAMP AS started, ts,
    event_id % 29 <> 0 AND event_id % 5 >= 3 AND value >= 15 AS ready FROM events),
spans AS (SELECT index_name, started, max(ts) AS last_sample, min(CASE WHEN ready THEN ts END) AS ready_at
  FROM samples GROUP BY 1, 2)
SELECT *, CASE WHEN ready_at <= started + INTERVAL 43200 SECONDS THEN 'ready'
  WHEN last_sample >= started + INTERVAL 43200 SECONDS THEN 'timeout' ELSE 'waiting' END AS outcome FROM spans""")
def _(t):
    # as a pattern, so that the table may be one file or a folder of many
    events = t.spark.readStream.schema(EVENTS).parquet(f"{t.sf_dir}/{{events}}.parquet")
    nodes = (F.col("event_id") % 5).cast("string")
    status = (F.when(F.col("value") >= 15, F.lit("green"))
              .when(F.col("value") >= 8, F.lit("yellow")).otherwise(F.lit("red")))
    reply = F.concat(F.lit('{"number_of_nodes":'), nodes, F.lit(',"status":"'), status, F.lit('"}'))
    samples = events.select(
        F.concat(F.lit("i"), F.col("user_id").cast("string")).alias("index_name"),
        F.date_trunc("day", "ts").cast("timestamp").alias("started"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_id") % 29 == 0, F.lit("curl: (7) refused")).otherwise(reply)
        .alias("content"))
    spans = drain(samples, ["index_name"], F.lit(3), scratch_dir(t.spark, "watch"),
                  scratch_dir(t.spark, "watch-progress"))
    done = watch_health(spans, ["index_name"], 43200)
    plain = ("started", "last_sample", "ready_at")
    return done.select("index_name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in plain],
                       "outcome")
