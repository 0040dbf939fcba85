import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from searchshift.operators import documents, manifest, mapping

NOW = 1700000000000


@pytest.fixture(scope="module")
def inputs(spark):
    files = [(b, s, f"_{i}.fdt", 10 + i, format(i, "x"), "9.8.0")
             for b, shards in (("b1", 5), ("b2", 1)) for s in range(shards) for i in range(23 + s)]
    raw = spark.createDataFrame(files, "backup_id string, shard_id bigint, name string, "
                                "length bigint, checksum string, written_by string")
    segments = spark.createDataFrame(
        [(b, s, f"_{k}", 7, "9.8.0") for b, n in (("b1", 5), ("b2", 1)) for s in range(n) for k in (0, 1)],
        "backup_id string, shard_id bigint, segment string, max_doc bigint, lucene_version string")
    described = manifest.with_meta_hash(raw)
    rollup = manifest.shard_rollup(described, segments)
    totals = manifest.conversion_rollup(rollup).withColumn(
        "index_name", F.concat(F.lit('my "idx" '), "backup_id")).withColumn("replicas", F.lit(2))
    return files, described, rollup, totals


def texts(parts):
    """Whole documents, joined in part order."""
    out = {}
    for r in parts.orderBy("backup_id", "rel_path", "part").collect():
        key = (r["backup_id"], r["rel_path"])
        out[key] = out.get(key, "") + r["body"]
    return out


def ids(totals):
    return {r["backup_id"]: r for r in documents.with_conversion_ids(totals).collect()}


def test_rollup(inputs, rows):
    files, _, rollup, totals = inputs
    by_shard = {(r["backup_id"], r["shard_id"]): r for r in rollup.collect()}
    assert by_shard[("b1", 2)]["files"] == 25 and by_shard[("b1", 2)]["max_docs"] == 14
    assert by_shard[("b1", 2)]["segments"] == 2 and by_shard[("b1", 2)]["lucene_version"] == "9.8.0"
    total = {r["backup_id"]: r for r in totals.collect()}
    assert total["b1"]["total_bytes"] == sum(f[3] for f in files if f[0] == "b1")
    assert total["b1"]["metadata_files"] == 15 and total["b2"]["metadata_files"] == 7
    assert {r["backup_id"] for r in manifest.shard_breakdown(rollup, totals).collect()} == {"b1"}


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_shard_documents(inputs, size):
    files, described, rollup, totals = inputs
    chunks = documents.file_chunks(described, size)
    named = rollup.join(totals.select("backup_id", "index_name"), "backup_id")
    snaps = texts(documents.shard_snapshot_doc(chunks, named, NOW))
    indexes = texts(documents.shard_index_doc(chunks, rollup))
    assert len(snaps) == len(indexes) == 6
    by_id = ids(totals)
    for (backup, path), text in snaps.items():
        shard = int(path.split("/")[2])
        mine = {f[2]: f for f in files if f[0] == backup and f[1] == shard}
        doc = json.loads(text)
        assert path == (f"indices/{by_id[backup]['index_id']}/{shard}/"
                        f"snap-{by_id[backup]['snapshot_id']}.dat")
        assert doc["name"] == f'my "idx" {backup}-snapshot' and doc["time"] == 0
        assert (doc["start_time"], doc["number_of_files"]) == (NOW, len(mine))
        assert doc["total_size"] == sum(f[3] for f in mine.values())
        assert {f["name"]: f["length"] for f in doc["files"]} == {n: f[3] for n, f in mine.items()}
        first = doc["files"][0]
        f = mine[first["name"]]
        digest = hashlib.sha256(f"{f[2]}{f[3]}{f[4]}{f[5]}".encode()).digest()
        assert first == {"name": f[2], "physical_name": f[2], "length": f[3], "written_by": f[5],
                         "checksum": f[4], "meta_hash": base64.b64encode(digest).decode()}
    for (backup, path), text in indexes.items():
        doc = json.loads(text)
        names = [f["name"] for f in doc["files"]]
        assert doc["snapshots"] == {by_id[backup]["snapshot_id"]: {"files": [{"name": n} for n in names]}}


def test_parts_are_bounded(inputs):
    _, described, _, _ = inputs
    counts = [len(json.loads("[" + r["names"].lstrip(",") + "]"))
              for r in documents.file_chunks(described, 5).collect()]
    assert sum(counts) == described.count() and max(counts) <= 15 and len(counts) > 20


@pytest.mark.parametrize("size", [2, 1000])
def test_conversion_documents(spark, inputs, size):
    _, _, rollup, totals = inputs
    by_id = ids(totals)
    fields = spark.createDataFrame([("b1", f"f{i}", "long") for i in range(9)],
                                   "backup_id string, field string, target_type string")
    snap = texts(documents.snapshot_doc(totals, NOW))
    doc = json.loads(snap[("b1", f"snap-{by_id['b1']['snapshot_id']}.dat")])["snapshot"]
    assert doc["name"] == 'my "idx" b1-snapshot' and doc["indices"] == ['my "idx" b1']
    assert (doc["state"], doc["version_id"], doc["metadata"], doc["failures"], doc["data_streams"]) == (
        "SUCCESS", 2110199, None, [], [])
    assert doc["total_shards"] == doc["successful_shards"] == 5 and doc["start_time"] == NOW
    meta = texts(documents.global_doc(totals))
    assert json.loads(meta[("b2", f"meta-{by_id['b2']['snapshot_id']}.dat")]) == {
        "meta-data": {"version": 1, "cluster_uuid": by_id["b2"]["snapshot_id"]}}

    index = json.loads(texts(documents.repo_index_doc(totals, rollup, size))[("b1", "index-0")])
    b1 = by_id["b1"]
    shard_ids = {(r["backup_id"], r["shard_id"]): r
                 for r in documents.with_shard_ids(rollup).collect()}
    key = b1["index_id"] + "-_na_-1-1-1"
    assert index["snapshots"] == [{
        "name": 'my "idx" b1-snapshot', "uuid": b1["snapshot_id"], "state": 1,
        "index_metadata_lookup": {b1["index_id"]: key}, "version": "2.11.1"}]
    assert index["indices"] == {'my "idx" b1': {
        "id": b1["index_id"], "snapshots": [b1["snapshot_id"]],
        "shard_generations": [shard_ids[("b1", i)]["generation_id"] for i in range(5)]}}
    assert index["index_metadata_identifiers"] == {key: b1["metadata_id"]}

    whole = texts(documents.index_doc(totals, rollup, mapping.build_mapping(fields, size), size))
    path = f"indices/{b1['index_id']}/meta-{b1['metadata_id']}.dat"
    doc = json.loads(whole[("b1", path)])['my "idx" b1']
    assert doc["settings"] == {
        "index.number_of_shards": "5", "index.number_of_replicas": "2",
        "index.version.created": "2110199", "index.uuid": b1["index_id"]}
    assert doc["mappings"] == [{"_doc": {"properties": {f"f{i}": {"type": "long"} for i in range(9)}}}]
    assert doc["primary_terms"] == {str(i): 1 for i in range(5)}
    assert doc["in_sync_allocations"] == {
        str(i): [shard_ids[("b1", i)]["allocation_id"]] for i in range(5)}
    b2 = by_id["b2"]
    other = json.loads(whole[("b2", f"indices/{b2['index_id']}/meta-{b2['metadata_id']}.dat")])
    assert other['my "idx" b2']["mappings"] == []


def test_commit_user_data(inputs):
    _, _, rollup, _ = inputs
    data = {(r["backup_id"], r["shard_id"]): r["user_data"]
            for r in manifest.commit_user_data(rollup).collect()}
    one = data[("b1", 0)]
    assert len(one) == 8 and one["max_seq_no"] == one["local_checkpoint"] == "13"
    assert (one["min_retained_seqno"], one["max_unsafe_auto_id_timestamp"], one["translog_gen"],
            one["min_translog_gen"]) == ("0", "-1", "1", "1")
    assert one["history_uuid"] != data[("b1", 1)]["history_uuid"]


def test_empty_shard_user_data(spark):
    shards = spark.createDataFrame([("b", 0, 0)], "backup_id string, shard_id bigint, max_docs bigint")
    assert manifest.commit_user_data(shards).first()["user_data"]["max_seq_no"] == "0"


def test_incomplete_conversion(spark, inputs):
    _, _, rollup, _ = inputs
    skipped = spark.createDataFrame([("b1", "WARN", "FILE_MISSING", "shard 0", "_9")],
                                    "backup_id string, severity string, code string, subject string, detail string")
    got = {r["backup_id"]: r["complete"] for r in manifest.conversion_rollup(rollup, skipped).collect()}
    assert got == {"b1": False, "b2": True}
