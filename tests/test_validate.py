import pytest
from pyspark.sql import functions as F

from searchshift import rules
from searchshift.operators import validate

from test_detect import INVENTORY, inventory, shard

GOOD = {"index-0": 300, "index.latest": 8, "snap-x.dat": 1, "meta-x.dat": 1,
        "indices/ix/meta-m.dat": 1, "indices/ix/0/snap-s.dat": 1, "indices/ix/0/index-g": 1,
        "indices/ix/0/segments_2": 1, "indices/ix/1/snap-s.dat": 1, "indices/ix/1/index-g": 1,
        "indices/ix/1/_0.fdt": 1}


def outputs(spark, files):
    rows = {("b", "", "", True, 0, True)}
    for path, length in files.items():
        folder, _, name = path.rpartition("/")
        if name:
            rows.add(("b", folder, name, False, length, True))
        while folder:
            parent, _, last = folder.rpartition("/")
            rows.add(("b", parent, last, True, 0, True))
            folder = parent
    return spark.createDataFrame(sorted(rows), INVENTORY)


def output_codes(spark, files, shards=2):
    tree = outputs(spark, files)
    expected = spark.createDataFrame([("b", i) for i in range(shards)],
                                     "backup_id string, shard_id bigint")
    found = validate.union_issues(
        validate.repo_files(tree, expected), validate.index_latest_size(tree),
        validate.index_dirs(tree, expected), validate.shard_files(tree, expected))
    return sorted(r["code"] for r in found.collect())


def without(*prefixes):
    return {p: n for p, n in GOOD.items() if not any(p.startswith(x) for x in prefixes)}


@pytest.mark.parametrize("files, codes", [
    (GOOD, []), (without("index-0"), ["REPO_INDEX_MISSING"]),
    (without("index.latest"), ["REPO_LATEST_MISSING"]), (without("snap-"), ["REPO_SNAPSHOT_MISSING"]),
    (without("meta-"), ["REPO_METADATA_MISSING"]), ({**GOOD, "index.latest": 3}, ["REPO_LATEST_SIZE"]),
    (without("indices"), ["INDICES_DIR_MISSING", "OUTPUT_SHARD_MISSING", "OUTPUT_SHARD_MISSING"]),
    ({**without("indices"), "indices/": 0}, ["INDEX_DIR_MISSING", "OUTPUT_SHARD_MISSING", "OUTPUT_SHARD_MISSING"]),
    (without("indices/ix/meta"), ["INDEX_METADATA_MISSING"]),
    (without("indices/ix/1"), ["OUTPUT_SHARD_MISSING"]),
    (without("indices/ix/0/snap"), ["SHARD_SNAPSHOT_MISSING"]),
    (without("indices/ix/0/index"), ["SHARD_INDEX_MISSING"]),
    (without("indices/ix/0/segments"), ["SHARD_FILES_MISSING"]),
    ({**GOOD, "indices/iy/meta-z.dat": 1}, ["INDEX_DIR_MULTIPLE"]),
    ({**GOOD, "indices/iw/0/": 0}, ["INDEX_DIR_MULTIPLE", "INDEX_METADATA_MISSING",
                                    "OUTPUT_SHARD_MISSING", "SHARD_FILES_MISSING",
                                    "SHARD_INDEX_MISSING", "SHARD_SNAPSHOT_MISSING"]),
])
def test_output_tree(spark, files, codes):
    assert output_codes(spark, files) == codes


def test_output_that_is_not_there(spark):
    nothing = outputs(spark, {}).limit(0)
    expected = spark.createDataFrame([("b", 0)], "backup_id string, shard_id bigint")
    found = [r["code"] for d in (validate.repo_files(nothing, expected), validate.index_dirs(nothing, expected),
                                 validate.shard_files(nothing, expected)) for r in d.collect()]
    assert sorted(found) == ["INDICES_DIR_MISSING", "OUTPUT_SHARD_MISSING", "REPO_INDEX_MISSING", "REPO_LATEST_MISSING",
                             "REPO_METADATA_MISSING", "REPO_SNAPSHOT_MISSING"]


def test_input_present(spark, rows):
    tree = inventory(spark, {"ok": [shard(1), shard(2)], "short": [shard(1)]})
    tree = tree.unionByName(spark.createDataFrame(
        [("locked", "", "", True, 0, False), ("locked", "", "snapshot.shard1", True, 0, False)], INVENTORY))
    planned = [(b, i) for b in ("ok", "short", "locked", "gone") for i in (0, 1)
               if (b, i) != ("locked", 1)]
    shards = spark.createDataFrame([(b, i, f"snapshot.shard{i + 1}") for b, i in planned],
                                   "backup_id string, shard_id bigint, dir string")
    found = validate.input_present(shards.select("backup_id").distinct(), shards, tree)
    assert rows(found, "backup_id", "code", "subject") == [
        ("gone", "INPUT_MISSING", ""), ("locked", "INPUT_UNREADABLE", ""),
        ("locked", "SHARD_DIR_UNREADABLE", "shard 1"), ("short", "SHARD_DIR_MISSING", "shard 2")]


def test_output_state(spark, rows):
    df = spark.createDataFrame(
        [("a", "/x", True, None), ("b", "/x", True, 0), ("c", "/x", True, 3), ("d", "/x", False, 1)],
        "backup_id string, output_dir string, writable boolean, entries bigint")
    assert rows(validate.output_state(df), "backup_id", "severity", "code", "detail") == [
        ("c", "WARN", "OUTPUT_NOT_EMPTY", "3"), ("d", "ERROR", "OUTPUT_NOT_WRITABLE", ""),
        ("d", "WARN", "OUTPUT_NOT_EMPTY", "1")]


@pytest.mark.parametrize("commits, codes", [
    ([("_0", 1, "9.8.0", False)], []), ([("_0", 1, "8.11.4", False)], []),
    ([("_0", 1, "7.7.3", False)], ["LIBRARY_OLD"]), ([("_0", 1, "6.6.6", False)], ["LIBRARY_TOO_OLD"]),
    ([(None, 0, "9.8.0", False)], ["NO_DOCUMENTS", "NO_SEGMENTS"]),
    ([("_0", 0, "9.8.0", False)], ["NO_DOCUMENTS"]), ([], ["COMMIT_UNREADABLE"]),
    ([(None, None, None, True)], ["COMMIT_UNREADABLE"]),
    ([("_0", 1, "10.1.0", False), ("_1", 0, "9.8.0", False)], [])])
def test_segment_health(spark, commits, codes):
    shards = spark.createDataFrame([("b", 0)], "backup_id string, shard_id bigint")
    segments = spark.createDataFrame(
        [("b", 0, *c) for c in commits], "backup_id string, shard_id bigint, segment string, "
        "max_doc bigint, lucene_version string, unreadable boolean")
    found = validate.segment_health(shards, segments).collect()
    assert sorted(r["code"] for r in found) == codes
    assert all(r["subject"] == "shard 1" for r in found)


def test_input_bytes(spark, rows):
    tree = inventory(spark, {"cloud": [shard(1), "snapshot.shard1/_0.cfs", "snapshot.shard1/deep/x", shard(2), "conf/a"],
                             "index": ["index/segments_1", "index/_0.cfs", "conf/a"],
                             "root": ["segments_1", "_0.cfs", "conf/a", "conf/b/c"]})
    shards = spark.createDataFrame([("cloud", 0, "snapshot.shard1"), ("cloud", 1, "snapshot.shard2"),
                                    ("index", 0, "index"), ("root", 0, "")],
                                   "backup_id string, shard_id bigint, dir string")
    assert rows(validate.input_bytes(tree, shards)) == [("cloud", 4), ("index", 2), ("root", 4)]


def test_disk_space(spark, rows):
    sizes = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 10 << 30)],
                                  "backup_id string, input_bytes bigint")
    volumes = spark.createDataFrame([("a", 1100, 1), ("b", 1099, 2), ("c", 1 << 30, 3)],
                                    "backup_id string, usable bigint, device bigint")
    assert rows(validate.disk_space(sizes, volumes), "backup_id", "severity", "detail") == [
        ("b", "WARN", "need 1.1 KB, have 1.1 KB"), ("c", "WARN", "need 11.00 GB, have 1.00 GB")]
    # two that fit alone and not together
    shared = spark.createDataFrame([("a", 2000, 1), ("b", 2000, 1), ("c", None, None)],
                                   "backup_id string, usable bigint, device bigint")
    assert rows(validate.disk_space(sizes, shared), "backup_id", "detail") == [
        ("a", "need 2.1 KB, have 2.0 KB"), ("b", "need 2.1 KB, have 2.0 KB")]


def test_gate_and_summary(spark, rows):
    issues = spark.createDataFrame(
        [("a", "WARN", "NO_DOCUMENTS", "", ""), ("b", "ERROR", "SHARD_GAP", "", ""),
         ("b", "WARN", "NO_DOCUMENTS", "", ""), ("b", "WARN", "NO_DOCUMENTS", "x", "")],
        "backup_id string, severity string, code string, subject string, detail string")
    backups = spark.createDataFrame([("a",), ("b",), ("c",)], "backup_id string")
    assert rows(validate.validation_gate(backups, issues)) == [("a",), ("c",)]
    assert rows(validate.issue_summary(issues), "severity", "code", "issues", "backups") == sorted([
        ("WARN", "NO_DOCUMENTS", 3, 2), ("ERROR", "SHARD_GAP", 1, 1), ("WARN", None, 3, 2),
        ("ERROR", None, 1, 1), (None, None, 4, 2)], key=repr)
    report = validate.report(issues).orderBy("check_order").collect()
    assert [r["code"] for r in report][0] == "SHARD_GAP" and report[0]["is_error"]


def test_every_code_has_a_place():
    assert len(rules.CHECK_ORDER) == len(rules.ISSUES)


def test_version_too_large_is_an_issue(spark):
    shards = spark.createDataFrame([("b", 0)], "backup_id string, shard_id bigint")
    segments = spark.createDataFrame([("b", 0, "_0", 1, "9.3000000.1"), ("b", 0, "_1", 1, "9.8.0")],
                                     "backup_id string, shard_id bigint, segment string, max_doc bigint, lucene_version string")
    assert [(r["severity"], r["code"]) for r in validate.segment_health(shards, segments).collect()] == [("ERROR", "VERSION_RANGE")]
