import json

from pyspark.sql import functions as F

from searchshift.operators import compat, status

REPLY = {"cluster": {"live_nodes": ["n2", "n1"], "collections": {
    "c1": {"replicationFactor": 2, "shards": {
        "shard1": {"replicas": {"r1": {"leader": "true", "node_name": "n1"}, "r2": {"node_name": "n2"}}},
        "shard2": {"replicas": {"r3": {"leader": "false", "node_name": "n2"}}},
        "shard3": {"replicas": {}}, "shard4": {}}},
    "c2": {"shards": {"s": {"replicas": {"r": {"leader": "true"}}}}}, "c3": {}}}}


def replies(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, content string")


def test_leaders(spark, rows):
    got = status.shard_leaders(replies(spark, json.dumps(REPLY), "no reply", "{}"), ["id"])
    assert rows(got) == [
        ("0", "c1", 4, "2", "shard1", 2, "n1"), ("0", "c1", 4, "2", "shard2", 1, "?"),
        ("0", "c1", 4, "2", "shard3", 0, "?"), ("0", "c1", 4, "2", "shard4", 0, "?"),
        ("0", "c2", 1, "?", "s", 1, "?")]


def test_nodes(spark, rows):
    df = replies(spark, json.dumps(REPLY), "no reply", "{}")
    assert rows(status.live_nodes(df, ["id"])) == [("0", 0, "n1"), ("0", 1, "n2")]
    assert rows(status.nodes_ready(df, ["id"], F.lit(2))) == [("0", 2, 2, True), ("1", 0, 2, False), ("2", 0, 2, False)]


def test_health(spark, rows):
    texts = ['{"number_of_nodes":3,"status":"green"}', '{"number_of_nodes":2,"status":"green"}',
             '{"number_of_nodes":3,"status":"yellow"}', "refused", "{}"]
    got = status.health_ready(replies(spark, *texts), F.lit(3))
    assert rows(got, "id", "nodes", "status", "cluster_ready", "restore_state") == [
        ("0", 3, "green", True, "done"), ("1", 2, "green", False, "done"), ("2", 3, "yellow", False, "waiting"),
        ("3", 0, "red", False, "waiting"), ("4", 0, "red", False, "waiting")]


def test_waiting(spark, rows):
    samples = [("soon", 0, False), ("soon", 60, True), ("late", 0, False), ("late", 120, False), ("late", 130, True),
               ("open", 0, False), ("open", 50, False), ("edge", 0, False), ("edge", 100, True)]
    df = spark.createDataFrame(samples, "k string, s int, ok boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = status.wait_outcome(df, ["k"], "ts", F.col("ok"), 100)
    assert rows(got, "k", "outcome") == [("edge", "ready"), ("late", "timeout"), ("open", "waiting"), ("soon", "ready")]


def test_compatibility(spark, rows):
    sources = spark.createDataFrame([("9.8.0",), ("9.8.0",), ("8.11.4",), ("7.7.3",), ("6.6.6",), (None,)], "lucene_version string")
    got = compat.matrix_status(compat.compatible_versions(sources))
    table = {(r["lucene_version"], r["target_version"]): (r["compatible"], r["tested"], r["status"]) for r in got.collect()}
    assert len(table) == 16
    assert table[("9.8.0", "2.11.1")] == ("YES", "YES", "PASS")
    assert table[("8.11.4", "2.11.1")] == ("YES", "YES", "PASS")
    assert table[("9.8.0", "2.19.1")] == ("YES", "NO", "-") and table[("9.8.0", "2.0")] == ("YES", "NO", "-")
    assert table[("9.8.0", "1.x")] == ("NO", "NO", "N/A") and table[("8.11.4", "1.x")] == ("YES", "NO", "-")
    assert table[("7.7.3", "2.11.1")] == ("NO", "YES", "FAIL") and table[("7.7.3", "1.x")] == ("MAYBE", "NO", "-")
    assert all(table[("6.6.6", t)] == ("NO", "NO", "N/A") for t in ("1.x", "2.0", "2.11.1", "2.19.1"))
    assert dict(rows(compat.matrix_counts(got), "status", "pairs")) == {"PASS": 2, "FAIL": 1, "N/A": 7, "-": 6}
    pivot = {r["lucene_version"]: r for r in compat.matrix_pivot(got).collect()}
    assert pivot["7.7.3"]["2.11.1"] == "FAIL"


START = 1_700_000_000


def test_stream_of_samples(spark, rows, tmp_path):
    from searchshift.streaming.watch import drain, watch_health
    good, bad = '{"number_of_nodes":3,"status":"green"}', "refused"
    samples = [("a", 0, 0, bad), ("a", 0, 30, good), ("b", 0, 0, bad), ("b", 0, 300, bad), ("c", 0, 5, bad), ("a", 500, 501, bad)]
    (spark.createDataFrame(samples, "k string, s int, t int, content string")
     .select("k", F.timestamp_seconds(F.col("s") + START).alias("started"),
             F.timestamp_seconds(F.col("t") + START).alias("ts"), "content")
     .repartition(3).write.parquet(str(tmp_path / "in")))
    stream = spark.readStream.schema("k string, started timestamp, ts timestamp, content string").option(
        "maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    spans = drain(stream, ["k"], F.lit(3), str(tmp_path / "waits"), str(tmp_path / "waits-progress"))
    shown = lambda df: rows(df.withColumn("s", F.unix_timestamp("started") - START), "k", "s", "outcome")
    assert shown(watch_health(spans, ["k"], 100)) == [
        ("a", 0, "ready"), ("a", 500, "waiting"), ("b", 0, "timeout"), ("c", 0, "waiting")]
    clock = F.timestamp_seconds(F.lit(START + 550))
    assert shown(watch_health(spans, ["k"], 100, clock)) == [
        ("a", 0, "ready"), ("a", 500, "waiting"), ("b", 0, "timeout"), ("c", 0, "timeout")]


def test_stream_out_of_order(spark, rows, tmp_path):
    """Many files, newest first, one per batch: the same outcomes as from stored samples."""
    from searchshift.streaming.watch import drain, watch_health
    good, bad = '{"number_of_nodes":3,"status":"green"}', "refused"
    samples = [(f"k{i % 7}", 86400 * (i // 70), 86400 * (i // 70) + 13 * (i % 70), good if i % 11 == 0 else bad)
               for i in range(420)]
    stored = spark.createDataFrame(samples, "k string, s int, t int, content string").select(
        "k", F.timestamp_seconds(F.col("s") + START).alias("started"),
        F.timestamp_seconds(F.col("t") + START).alias("ts"), "content")
    folder = str(tmp_path / "in.parquet")
    for part in reversed(range(6)):
        stored.where((F.unix_timestamp("started") - START) == 86400 * part).coalesce(1).write.mode("append").parquet(folder)
    schema = "k string, started timestamp, ts timestamp, content string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = watch_health(drain(stream, ["k"], F.lit(3), str(tmp_path / "waits"), str(tmp_path / "waits-progress")), ["k"], 300)
    judged = status.health_ready(stored, F.lit(3))
    want = judged.groupBy("k", "started").agg(
        F.max("ts").alias("last_sample"), F.min(F.when(F.col("cluster_ready"), F.col("ts"))).alias("ready_at"))
    assert rows(got.drop("outcome")) == rows(want) and got.count() == 42
    assert {r["outcome"] for r in got.collect()} == {"ready", "timeout"}


def test_stream_over_one_file(spark, tmp_path):
    """A table that is one file, and a stream without any batch."""
    from searchshift.streaming.watch import drain
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"k": ["a"], "content": ["refused"]}), str(tmp_path / "one.parquet"))
    stream = spark.readStream.schema("k string, content string").parquet(str(tmp_path / "{one}.parquet"))
    now = F.timestamp_seconds(F.lit(START))
    timed = stream.select("k", now.alias("started"), now.alias("ts"), "content")
    assert drain(timed, ["k"], F.lit(3), str(tmp_path / "one"), str(tmp_path / "one-progress")).count() == 1
    assert drain(timed.where("k = 'b'"), ["k"], F.lit(3), str(tmp_path / "none"), str(tmp_path / "none-progress")).count() == 0


def test_stream_goes_on_where_it_stopped(spark, rows, tmp_path):
    """Stopped by an error after some batches, restarted over more files, compacted, restarted again."""
    import pytest

    from searchshift.streaming import watch
    good, bad = '{"number_of_nodes":3,"status":"green"}', "refused"
    folder, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    schema = "k string, started timestamp, ts timestamp, content string"

    def arrive(*samples):
        (spark.createDataFrame(samples, "k string, s int, t int, content string").select(
            "k", F.timestamp_seconds(F.col("s") + START).alias("started"), F.timestamp_seconds(F.col("t") + START).alias("ts"),
            "content").coalesce(1).write.mode("append").parquet(folder))
    run = lambda: watch.drain(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), ["k"], F.lit(3), table, progress)
    shown = lambda df: rows(watch.watch_health(df, ["k"], 100).select("k", "outcome"))
    arrive(("a", 0, 0, bad))
    arrive(("a", 0, 30, good), ("b", 0, 0, bad))
    arrive(("b", 0, 300, bad))
    judge, seen = watch.health_ready, []

    def failing(batch, nodes):
        seen.append(batch.count())
        if len(seen) == 3:
            raise RuntimeError("lost")
        return judge(batch, nodes)
    watch.health_ready = failing
    try:
        with pytest.raises(Exception, match="lost"):
            run()
        assert len(seen) == 3 and len(watch._folders(spark, table)) == 2
        arrive(("c", 0, 5, bad))
        spans = run()
        # the batch that failed and the file that came after it, and nothing else
        assert len(seen) == 5 and sorted(seen[3:]) == [1, 1]
        assert shown(spans) == [("a", "ready"), ("b", "timeout"), ("c", "waiting")]
        merged = watch.compact(spark, table, ["k"], spans.schema)
        assert list(watch._folders(spark, table)) == ["merged=0"] and merged.count() == 3
        arrive(("c", 0, 60, good))
        spans = run()
        assert len(seen) == 6 and shown(spans) == [("a", "ready"), ("b", "timeout"), ("c", "ready")]
        assert watch.compact(spark, table, ["k"], spans.schema).count() == 3
        assert list(watch._folders(spark, table)) == ["merged=1"]
    finally:
        watch.health_ready = judge
