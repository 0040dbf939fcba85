import random

import pytest
from pyspark.sql import functions as F

from searchshift.operators import detect
from searchshift.sources.state import collection_state

INVENTORY = "backup_id string, rel_dir string, name string, is_dir boolean, length bigint, readable boolean"


def inventory(spark, trees):
    """Trees as {backup: [path, ...]}; a path ending in / is a folder."""
    rows = []
    for backup, paths in trees.items():
        rows.append((backup, "", "", True, 0, True))
        folders = set()
        for path in paths:
            pieces = path.rstrip("/").split("/")
            inner = pieces if path.endswith("/") else pieces[:-1]
            for i in range(len(inner)):
                folders.add("/".join(inner[:i + 1]))
            if not path.endswith("/"):
                rows.append((backup, "/".join(pieces[:-1]), pieces[-1], False, 1, True))
        for folder in folders:
            parent, _, name = folder.rpartition("/")
            rows.append((backup, parent, name, True, 0, True))
    return spark.createDataFrame(rows, INVENTORY)


def shard(n, commit=True):
    return f"snapshot.shard{n}/" + ("segments_2" if commit else "")


CASES = {
    "root commit": (["segments_1"], "STANDALONE", None, 1),
    "index commit": (["index/segments_5", "index/_0.cfs"], "STANDALONE", None, 1),
    "two shards": ([shard(1), shard(2)], "SOLRCLOUD_FULL", None, 2),
    "four shards": ([shard(i) for i in (3, 1, 4, 2)], "SOLRCLOUD_FULL", None, 4),
    "eleven shards": ([shard(i) for i in range(1, 12)], "SOLRCLOUD_FULL", None, 11),
    "gap": ([shard(1), shard(3)], None, "SHARD_GAP", None),
    "no first": ([shard(2)], None, "SHARD_GAP", None),
    "zero": ([shard(0), shard(1)], None, "SHARD_GAP", None),
    "twice": ([shard(1), "snapshot.shard01/segments_1"], None, "SHARD_GAP", None),
    "too large": ([shard(1), shard(99999999999)], None, "SHARD_NUMBER_RANGE", None),
    "no commit": ([shard(1), shard(2, False)], None, "SHARD_WITHOUT_COMMIT", None),
    "gap first": ([shard(1, False), shard(3)], None, "SHARD_GAP", None),
    "incremental": (["backup_0.properties", shard(1)], None, "INCREMENTAL_BACKUP", None),
    "incremental child": (["coll/backup_0.properties", shard(1)], None, "INCREMENTAL_BACKUP", None),
    "deep marker": (["a/b/backup_0.properties", shard(1)], "SOLRCLOUD_FULL", None, 1),
    "complete marker": (["backup.properties", shard(1)], "SOLRCLOUD_FULL", None, 1),
    "empty": ([], None, "UNKNOWN_FORMAT", None),
    "other files": (["readme.txt", "data/segments_1"], None, "UNKNOWN_FORMAT", None),
    "sub-shard": (["snapshot.shard1_0/segments_1"], None, "UNKNOWN_FORMAT", None),
    "sub-shard aside": ([shard(1), "snapshot.shard1_0/segments_1"], "SOLRCLOUD_FULL", None, 1),
    "shards before root": ([shard(1), "segments_1"], "SOLRCLOUD_FULL", None, 1),
    "shard named file": (["snapshot.shard1", "segments_1"], "STANDALONE", None, 1),
}


def test_classification(spark):
    found = detect.classify_format(inventory(spark, {k: c[0] for k, c in CASES.items()})).collect()
    assert {r["backup_id"]: (r["format"], r["issue_code"], r["shard_count"]) for r in found} == {
        k: c[1:] for k, c in CASES.items()}


def test_root_is_a_file(spark, rows):
    df = spark.createDataFrame([("b", "", "", False, 5, True)], INVENTORY)
    assert rows(detect.classify_format(df), "format", "issue_code") == [(None, "NOT_A_DIRECTORY")]


def test_shards_and_plan(spark, rows):
    tree = inventory(spark, {"a": [shard(i) for i in range(1, 12)], "s": ["index/segments_1"],
                             "r": ["segments_1"], "bad": [shard(2)]})
    planned = detect.plan_shards(detect.classify_format(tree), detect.shard_dirs(tree),
                                 detect.standalone_index(tree))
    assert rows(planned) == sorted(
        [("a", i - 1, f"snapshot.shard{i}") for i in range(1, 12)]
        + [("s", 0, "index"), ("r", 0, "")], key=repr)
    assert rows(detect.unmatched_shard_dirs(tree)) == []


def brute_force_gap(numbers):
    for i, n in enumerate(sorted(numbers), start=1):
        if n != i:
            return i, n
    return None


def test_gaps_against_brute_force(spark):
    rng = random.Random(7)
    cases = {f"b{i}": [rng.randint(0 if rng.random() < 0.2 else 1, rng.randint(1, 9))
                       for _ in range(rng.randint(1, 8))] for i in range(150)}
    cases |= {f"c{i}": list(range(1, i + 1)) for i in range(1, 20)}
    cases |= {f"d{i}": [*range(1, i + 1), rng.randint(1, 25)] for i in range(1, 40)}
    df = spark.createDataFrame([(b, n) for b, ns in cases.items() for n in ns],
                               "backup_id string, shard_number bigint")
    got = {r["backup_id"]: (r["expected"], r["actual"]) for r in detect.shard_gaps(df).collect()}
    want = {b: g for b, ns in cases.items() if (g := brute_force_gap(ns))}
    assert got == want


@pytest.mark.parametrize("present, chosen", [
    (["zk_backup/configs/_default/managed-schema.xml", "conf/managed-schema"], 0),
    (["zk_backup/configs/_default/managed-schema", "zk_backup_0/configs/_default/managed-schema.xml"], 0),
    (["conf/managed-schema", "zk_backup_0/configs/_default/managed-schema.xml"], 1),
    (["zk_backup_0/configs/_default/managed-schema"], 0),
    (["conf/managed-schema", "conf/managed-schema.xml"], 1), (["conf/managed-schema"], 0)])
def test_schema_path(spark, rows, present, chosen):
    tree = inventory(spark, {"b": [shard(1), *present], "none": [shard(1), "conf/other.xml"]})
    assert rows(detect.resolve_schema_path(tree)) == [("b", present[chosen])]


@pytest.mark.parametrize("contents, factor", [
    (['{"c":{"replicationFactor":2}}'], 2), (['{"c":{"replicationFactor":"3"}}'], 3),
    ([None, '{"c":{"replicationFactor":4}}'], 4), (["not json", '{"c":{"replicationFactor":4}}'], 4),
    (['{"c":{}}', '{"c":{"replicationFactor":4}}'], 4), (['{"c":{"replicationFactor":"many"}}',
                                                          '{"c":{"replicationFactor":4}}'], -1),
    (['{"b":{"replicationFactor":5},"a":{"replicationFactor":1}}'], 5), (["not json"], -1),
    ([""], -1), (["{}"], -1), (['{"c":{"replicationFactor":0}}'], 0),
    (['{"c":{"replicationFactor":-1}}'], -1), (['{"c":{"replicationFactor":2.9}}'], 2),
    (['{"c":{"replicationFactor":null}}', '{"c":{"replicationFactor":4}}'], -1)])
def test_replication_factor(spark, rows, contents, factor):
    df = spark.createDataFrame([("b", i, c) for i, c in enumerate(contents) if c is not None],
                               "backup_id string, dir_rank int, content string")
    assert rows(collection_state(df)) == [("b", factor)]


@pytest.mark.parametrize("kind, factor, asked, replicas, source", [
    ("SOLRCLOUD_FULL", 3, -1, 2, "replication_factor"), ("SOLRCLOUD_FULL", 1, -1, 0, "replication_factor"),
    ("SOLRCLOUD_FULL", 0, -1, 0, "default"), ("SOLRCLOUD_FULL", -1, -1, 0, "default"),
    ("SOLRCLOUD_FULL", None, None, 0, "default"), ("SOLRCLOUD_FULL", 3, 0, 0, "explicit"),
    ("SOLRCLOUD_FULL", 3, 5, 5, "explicit"), ("STANDALONE", 3, -1, 0, "default")])
def test_replicas(spark, rows, kind, factor, asked, replicas, source):
    df = spark.createDataFrame([(kind, factor, asked)],
                               "format string, replication_factor int, asked int")
    assert rows(detect.resolve_replicas(df, "asked"), "replicas", "replica_source") == [
        (replicas, source)]


def test_latest_commit_is_numeric(spark, rows):
    tree = inventory(spark, {"b": [f"d/segments_{s}" for s in ("9", "a", "10", "z")]
                             + ["segments_2", "segments.gen", "d/segments_bad-name"]})
    assert rows(detect.latest_commit(tree)) == [("b", "", 2, "segments_2"), ("b", "d", 36, "segments_10")]


def test_live_and_missing_files(spark, rows):
    segments = spark.createDataFrame([("b", 0, ["_0.a", "_0.b"]), ("b", 0, ["_0.b", "_1.a"])],
                                     "backup_id string, shard_id bigint, files array<string>")
    files = spark.createDataFrame([("b", 0, "_0.a", 1), ("b", 0, "_0.b", 2), ("b", 0, "_old", 3),
                                   ("b", 1, "_1.a", 4)],
                                  "backup_id string, shard_id bigint, name string, length bigint")
    assert rows(detect.live_files(segments, files), "name", "length") == [("_0.a", 1), ("_0.b", 2)]
    assert rows(detect.missing_files(segments, files)) == [
        ("b", "WARN", "FILE_MISSING", "shard 1", "_1.a")]
