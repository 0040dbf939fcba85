import glob
import json
import os

from searchshift.plans.convert import convert_backups

from test_files import index_file

SCHEMA = """<schema><fieldType name="body" class="solr.TextField"/><field name="id" type="string"/>
<field name="text" type="body"/><field name="_version_" type="plong"/></schema>"""


def write(path, text=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def make(root):
    """Backups of every fate; returns the segments of the readable ones."""
    segments = []

    def shard(backup, number, folder, names, version="9.8.0", absent=()):
        for name in names:
            if name not in absent:
                index_file(f"{root}/{backup}/{folder}/{name}", f"{backup}/{number}/{name}".encode() * 50)
        index_file(f"{root}/{backup}/{folder}/segments_2", b"commit")
        index_file(f"{root}/{backup}/{folder}/segments_1", b"older commit")
        write(f"{root}/{backup}/{folder}/_stale.fdt", "not referenced")
        segments.append((backup, number, "_0", 10 * (number + 1), version, list(names)))
        if backup == "cloud":  # an older segment of the same commit
            segments.append((backup, number, "_x", 0, "8.11.4", list(names[:1])))

    shard("cloud", 0, "snapshot.shard1", ["_0.fdt", "_0.si"])
    shard("cloud", 1, "snapshot.shard2", ["_0.fdt", "_0.si", "_0.gone"], absent=("_0.gone",))
    write(f"{root}/cloud/zk_backup/configs/_default/managed-schema", SCHEMA)
    write(f"{root}/cloud/zk_backup/collection_state.json", '{"c":{"replicationFactor":"2"}}')
    shard("single", 0, "index", ["_0.cfs"])
    shard("old", 0, "index", ["_0.cfs"], "6.6.6")
    shard("gap", 0, "snapshot.shard2", ["_0.cfs"])
    shard("badxml", 0, "index", ["_0.cfs"])
    write(f"{root}/badxml/conf/managed-schema", "<schema><open></schema>")
    shard("badfile", 0, "index", ["_0.cfs"])
    write(f"{root}/badfile/index/_0.cfs", "no footer here, but long enough to hold one")
    write(f"{root}/incremental/backup_0.properties")
    shard("torn", 0, "index", ["_0.cfs"])
    with open(f"{root}/torn/index/_0.cfs", "r+b") as f:
        f.write(b"?")
    shard("blocked", 0, "index", ["_0.cfs"])
    for name in ("twice", "outer", "inner", "own"):
        shard(name, 0, "index", ["_0.cfs"])
    return segments


def test_backups_of_every_fate(spark, tmp_path, rows):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    segments = spark.createDataFrame(make(root), "backup_id string, shard_id bigint, segment string, "
                                     "max_doc bigint, lucene_version string, files array<string>")
    names = ["cloud", "single", "old", "gap", "badxml", "badfile", "incremental", "absent", "torn", "twice", "twice"]
    write(f"{out}/file", "not a folder")
    odd = [("blocked", f"{out}/file/below"), ("outer", f"{out}/shared/"), ("inner", f"{out}//shared/./in"),
           ("own", f"{root}/own/out")]
    backups = spark.createDataFrame(
        [(n, f"{root}/{n}", f"{out}/{n}", f"idx_{n}", 4 if n == "single" else -1) for n in names]
        + [(n, f"{root}/{n}", o, f"idx_{n}", -1) for n, o in odd],
        "backup_id string, input_dir string, output_dir string, index_name string, replicas int")
    done = convert_backups(backups, segments, 1700000000000, range_bytes=64)

    results = {r["backup_id"]: r for r in done.results.collect()}
    assert set(results) == {"cloud", "single"}
    cloud, single = results["cloud"], results["single"]
    assert (cloud["total_shards"], cloud["total_docs"], cloud["total_files"], cloud["replicas"],
            cloud["metadata_files"], cloud["complete"]) == (2, 30, 6, 1, 9, False)
    assert (single["format"], single["replicas"], single["replica_source"], single["complete"]) == (
        "STANDALONE", 4, "explicit", True)
    errors = {(b, c) for b, s, c in rows(done.issues, "backup_id", "severity", "code") if s == "ERROR"}
    assert errors == {("old", "LIBRARY_TOO_OLD"), ("gap", "SHARD_GAP"), ("badxml", "SCHEMA_UNREADABLE"),
                      ("badfile", "FOOTER_INVALID"), ("incremental", "INCREMENTAL_BACKUP"),
                      ("absent", "NOT_A_DIRECTORY"), ("torn", "CHECKSUM_MISMATCH"),
                      ("blocked", "OUTPUT_NOT_WRITABLE"), ("twice", "DUPLICATE_BACKUP"), ("outer", "OUTPUT_SHARED"),
                      ("inner", "OUTPUT_SHARED"), ("own", "OUTPUT_SHARED")}
    warnings = {(b, c) for b, s, c in rows(done.issues, "backup_id", "severity", "code") if s == "WARN"}
    assert {("cloud", "FILE_MISSING"), ("single", "SCHEMA_MISSING")} <= warnings
    assert {r["backup_id"] for r in done.shards.collect()} == {"cloud"}

    base = f"{out}/cloud"
    assert sorted(n for n in os.listdir(base) if os.path.isfile(f"{base}/{n}")) == sorted([
        "index-0", "index.latest", f"meta-{cloud['snapshot_id']}.dat", f"snap-{cloud['snapshot_id']}.dat"])
    with open(f"{base}/index.latest", "rb") as f:
        assert f.read() == bytes(8)
    with open(f"{base}/index-0") as f:
        assert json.load(f)["indices"]["idx_cloud"]["id"] == cloud["index_id"]
    index = f"{base}/indices/{cloud['index_id']}"
    assert sorted(os.listdir(index)) == sorted(["0", "1", f"meta-{cloud['metadata_id']}.dat"])
    with open(f"{index}/meta-{cloud['metadata_id']}.dat") as f:
        doc = json.load(f)["idx_cloud"]
    assert doc["mappings"] == [{"_doc": {"properties": {"id": {"type": "keyword"}, "text": {"type": "text"}}}}]
    assert doc["settings"]["index.number_of_replicas"] == "1"
    for shard, expected in (("0", {"_0.fdt", "_0.si", "segments_2"}), ("1", {"_0.fdt", "_0.si", "segments_2"})):
        there = set(os.listdir(f"{index}/{shard}"))
        data = {n for n in there if not n.startswith(("snap-", "index-"))}
        assert data == expected and len(there) == len(data) + 2
        for name in data:
            with open(f"{root}/cloud/snapshot.shard{int(shard) + 1}/{name}", "rb") as a, \
                    open(f"{index}/{shard}/{name}", "rb") as b:
                assert a.read() == b.read()
        with open(f"{index}/{shard}/snap-{cloud['snapshot_id']}.dat") as f:
            snap = json.load(f)
        assert {f["name"] for f in snap["files"]} == expected and snap["name"] == "idx_cloud-snapshot"
    assert {r["rel_path"] for r in done.written.collect() if r["root"] == base} == {
        os.path.relpath(f"{d}/{n}", base) for d, _, names in os.walk(base) for n in names
        if n.startswith(("snap-", "meta-", "index"))}
    assert not os.path.exists(f"{out}/old") and not os.path.exists(f"{out}/gap")
    assert not os.path.exists(f"{out}/badxml") and not glob.glob(f"{out}/badxml.staging*")
    assert not os.path.exists(f"{out}/torn") and not glob.glob(f"{out}/cloud.staging*")
    commits = {(r["backup_id"], r["shard_id"]): r["user_data"] for r in done.commits.collect()}
    assert set(commits) == {("cloud", 0), ("cloud", 1), ("single", 0)} and commits["cloud", 1]["max_seq_no"] == "19"

    # a second run over the same output changes nothing but the warning
    again = convert_backups(backups, segments, 1700000000000)
    assert {r["backup_id"]: r["index_id"] for r in again.results.collect()} == {
        k: r["index_id"] for k, r in results.items()}
    assert ("cloud", "OUTPUT_NOT_EMPTY") in set(rows(again.issues, "backup_id", "code"))
    assert ("cloud", "INDEX_DIR_MULTIPLE") not in set(rows(again.issues, "backup_id", "code"))


def test_versions_and_commit_names(spark, tmp_path):
    """One version per shard, and the commit under the name it has."""
    from searchshift.operators import detect
    from searchshift.plans.convert import _referenced
    inventory = spark.createDataFrame(
        [("b", "index", n, False) for n in ("segments_0A", "segments_2", "segments_zzzzzzzzzzzzz")],
        "backup_id string, rel_dir string, name string, is_dir boolean")
    shards = spark.createDataFrame([("b", 0, "index")], "backup_id string, shard_id bigint, dir string")
    segments = spark.createDataFrame([("b", 0, "8.11.4", ["_0.a"]), ("b", 0, "9.8.0", ["_1.a", "_0.a"])],
                                     "backup_id string, shard_id bigint, lucene_version string, files array<string>")
    got = _referenced(segments, inventory, shards)
    assert sorted((r["name"], r["written_by"]) for r in got.collect()) == [
        ("_0.a", "9.8.0"), ("_1.a", "9.8.0"), ("segments_0A", "9.8.0")]
    assert [(r["code"], r["detail"]) for r in detect.commit_name_issues(inventory).collect()] == [
        ("COMMIT_NAME_INVALID", "segments_zzzzzzzzzzzzz")]


def test_parts_that_occur_twice(spark, tmp_path):
    import pytest

    from searchshift.sinks.repository import write_repository
    parts = spark.createDataFrame([(str(tmp_path), "a", 0, "x"), (str(tmp_path), "a", 0, "y")],
                                  "root string, rel_path string, part bigint, body string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        write_repository(parts)


def test_one_bad_root_beside_a_good_one(spark, tmp_path):
    from searchshift.sinks.repository import write_repository
    write(f"{tmp_path}/file", "in the way")
    parts = spark.createDataFrame([(f"{tmp_path}/good", "a/b", 0, "x"), (f"{tmp_path}/file/below", "a", 0, "y")],
                                  "root string, rel_path string, part bigint, body string")
    got = {r["rel_path"]: r["ok"] for r in write_repository(parts).collect()}
    assert got == {"a/b": True, "a": False} and os.path.getsize(f"{tmp_path}/good/a/b") == 1


def test_shared_targets(spark, rows):
    from searchshift.operators.validate import shared_targets
    df = spark.createDataFrame(
        [("a", "/in/a", "/out/a"), ("b", "/in/b", "/out/a/"), ("c", "/in/c", "/out/cc"), ("d", "/in/d", "/out/cc/x/y"),
         ("e", "/in/e", "/in/c/out"), ("f", "/in/f/g", "/in/f"), ("g", "/in/g", "/out/g"), ("g", "/in/g", "/out/g"),
         ("h", "/in/same", "/out/h"), ("i", "/in/same", "/out/hh")], "backup_id string, input_dir string, output_dir string")
    assert rows(shared_targets(df), "backup_id", "code") == [
        ("a", "OUTPUT_SHARED"), ("b", "OUTPUT_SHARED"), ("c", "OUTPUT_SHARED"), ("d", "OUTPUT_SHARED"),
        ("e", "OUTPUT_SHARED"), ("f", "OUTPUT_SHARED"), ("g", "DUPLICATE_BACKUP")]


def test_a_run_that_failed_leaves_no_trace_in_the_next(spark, tmp_path, monkeypatch):
    """Lost between writing and publishing, with a shard that the input no longer has when it is run again."""
    import shutil

    import pytest

    from searchshift.plans import convert
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    segments = []
    for number in (0, 1):
        folder = f"{root}/b/snapshot.shard{number + 1}"
        index_file(f"{folder}/_0.cfs", f"{number}".encode() * 90)
        index_file(f"{folder}/segments_2", b"commit")
        segments.append(("b", number, "_0", 10, "9.8.0", ["_0.cfs"]))
    schema = "backup_id string, shard_id bigint, segment string, max_doc bigint, lucene_version string, files array<string>"
    backups = spark.createDataFrame([("b", f"{root}/b", f"{out}/b", "idx", 1)],
                                    "backup_id string, input_dir string, output_dir string, index_name string, replicas int")
    publish = convert.publish_files

    def lost(*_):
        raise RuntimeError("lost before publishing")
    monkeypatch.setattr(convert, "publish_files", lost)
    with pytest.raises(RuntimeError, match="lost"):
        convert_backups(backups, spark.createDataFrame(segments, schema), 0, run="first")
    assert not os.path.exists(f"{out}/b") and os.path.isdir(f"{out}/b.staging-first")
    monkeypatch.setattr(convert, "publish_files", publish)
    shutil.rmtree(f"{root}/b/snapshot.shard2")
    done = convert_backups(backups, spark.createDataFrame(segments[:1], schema), 0, run="second")
    result = done.results.collect()[0]
    assert (result["total_shards"], result["total_docs"]) == (1, 10)
    index = f"{out}/b/indices/{result['index_id']}"
    assert sorted(os.listdir(index)) == sorted(["0", f"meta-{result['metadata_id']}.dat"])
    assert {"_0.cfs", "segments_2"} <= set(os.listdir(f"{index}/0")) and os.path.exists(f"{out}/b/index.latest")
    assert not os.path.exists(f"{out}/b.staging-second") and os.path.isdir(f"{out}/b.staging-first")


def test_publishing_moves_the_manifest_and_nothing_else(spark, tmp_path):
    from searchshift.sinks.repository import publish_files
    write(f"{tmp_path}/good.s/a/x", "12")
    write(f"{tmp_path}/good.s/last", "3")
    write(f"{tmp_path}/good.s/stray", "from nowhere")
    write(f"{tmp_path}/moved/a/x", "12")  # by an attempt that was lost
    write(f"{tmp_path}/moved.s/last", "3")
    write(f"{tmp_path}/torn.s/a/x", "1")
    write(f"{tmp_path}/torn.s/last", "3")
    files = spark.createDataFrame(
        [(b, f"{tmp_path}/{b}.s", f"{tmp_path}/{b}", p, n) for b in ("good", "moved", "torn") for p, n in (("a/x", 2), ("last", 1))],
        "backup_id string, staged string, target string, rel_path string, length bigint")
    for _ in range(2):  # a second time changes nothing
        assert {r["backup_id"]: r["ok"] for r in publish_files(files, "last").collect()} == {
            "good": True, "moved": True, "torn": False}
        assert sorted(os.listdir(f"{tmp_path}/good")) == ["a", "last"] and os.listdir(f"{tmp_path}/good.s") == ["stray"]
        assert not os.path.exists(f"{tmp_path}/moved.s") and not os.path.exists(f"{tmp_path}/torn")
