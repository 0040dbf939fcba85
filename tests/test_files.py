import json
import os
import zlib

import pytest
from pyspark.sql import functions as F

from searchshift.functions.values import stored_checksum
from searchshift.operators.manifest import verify_checksum
from searchshift.operators.numbering import number_rows, running_total
from searchshift.sinks.copy import copy_files, file_crc
from searchshift.sinks.repository import write_batches, write_repository
from searchshift.sources import files, records

FOOTER = bytes.fromhex("C02893E800000000")


def index_file(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lead = body + FOOTER
    with open(path, "wb") as f:
        f.write(lead + zlib.crc32(lead).to_bytes(8, "big"))


@pytest.fixture
def tree(tmp_path):
    root = str(tmp_path / "in")
    for shard in (1, 2):
        for i in range(5):
            index_file(f"{root}/snapshot.shard{shard}/_{i}.fdt", os.urandom(1000 * i + shard))
    index_file(f"{root}/zk_backup/configs/_default/managed-schema", b"<schema/>")
    os.makedirs(f"{root}/empty")
    open(f"{root}/snapshot.shard1/zero", "wb").close()
    return root


def listing(root):
    out = {("", "", True, 0)}
    for folder, dirs, names in os.walk(root):
        rel = os.path.relpath(folder, root).replace(".", "", 1) if folder == root else os.path.relpath(folder, root)
        out |= {(rel, d, True, 0) for d in dirs}
        out |= {(rel, n, False, os.path.getsize(f"{folder}/{n}")) for n in names}
    return out


def test_scan(spark, tree):
    roots = spark.createDataFrame([("a", tree), ("b", tree + "-nowhere"), ("c", f"{tree}/empty")],
                                  "backup_id string, root string")
    got = files.scan_files(roots).collect()
    assert {(r["rel_dir"], r["name"], r["is_dir"], r["length"])
            for r in got if r["backup_id"] == "a"} == listing(tree)
    assert len([r for r in got if r["backup_id"] == "a"]) == len(listing(tree))
    assert [(r["name"], r["is_dir"]) for r in got if r["backup_id"] == "c"] == [("", True)]
    assert not [r for r in got if r["backup_id"] == "b"]


def test_root_that_is_a_file(spark, tree):
    roots = spark.createDataFrame([("a", f"{tree}/snapshot.shard1/zero")], "backup_id string, root string")
    assert [r["is_dir"] for r in files.scan_files(roots).collect()] == [False]


def test_links_and_deep_trees(spark, tmp_path):
    deep = tmp_path / "/".join("abcdefgh")
    deep.mkdir(parents=True)
    (deep / "file").write_text("x")
    os.symlink(tmp_path, tmp_path / "a" / "loop")
    os.symlink(deep / "file", tmp_path / "link")
    os.symlink(tmp_path / "nowhere", tmp_path / "broken")
    roots = spark.createDataFrame([("a", str(tmp_path))], "backup_id string, root string")
    got = {(r["rel_dir"], r["name"]): r for r in files.scan_files(roots).collect()}
    assert len(got) == 1 + 8 + 4
    assert got["a", "loop"]["is_dir"] and not got["", "link"]["is_dir"] and got["", "link"]["length"] == 1
    assert not got["", "broken"]["readable"] and got["a/b/c/d/e/f/g/h", "file"]["length"] == 1


def test_listing_that_breaks_off(tmp_path, monkeypatch):
    class Broken:
        def __enter__(self):
            return iter(self.entries())

        def __exit__(self, *_):
            return False

        def entries(self):
            yield from ()
            raise OSError("stale handle")

    (tmp_path / "d").mkdir()
    import pandas as pd
    unseen = pd.DataFrame([files._unseen("b", str(tmp_path), "", "d"), files._unseen("b", str(tmp_path), "", "f")],
                          columns=files._columns(files.ENTRY))
    (tmp_path / "f").write_text("x")
    monkeypatch.setattr(files.os, "scandir", lambda _: Broken())
    assert files._look("b", str(tmp_path), "", "d")[4:7] == (True, 0, True)
    got = pd.concat(files._stage(iter([unseen]))).values.tolist()
    assert [(r[3], r[4], r[6]) for r in got] == [("d", True, False), ("f", False, True)]
    with pytest.raises(OSError):
        list(files._children(str(tmp_path)))


def test_a_listing_that_breaks_off_half_way(tmp_path, monkeypatch):
    """What was named before stays, the folder is told as not readable, and it is listed only once."""
    import pandas as pd
    listed, whole = [], os.scandir
    for name in ("good/a", "good/b", "bad/a", "bad/b"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")

    class Breaking:
        def __init__(self, folder):
            listed.append(os.path.basename(folder))
            self.folder, self.entries = folder, whole(folder)

        def __enter__(self):
            return self.names()

        def __exit__(self, *_):
            self.entries.close()

        def names(self):
            for k, entry in enumerate(self.entries):
                if k and self.folder.endswith("bad"):
                    raise OSError("stale handle")
                yield entry
    monkeypatch.setattr(files.os, "scandir", Breaking)
    unseen = pd.DataFrame([files._unseen("b", str(tmp_path), "", n) for n in ("bad", "good")],
                          columns=files._columns(files.ENTRY))
    got = pd.concat(files._stage(iter([unseen])))
    seen = {r.name: r.readable for r in got.itertuples() if r.seen}
    assert seen == {"bad": False, "good": True} and listed == ["bad", "good"]
    assert got[~got["seen"]].groupby("rel_dir").size().to_dict() == {"bad": 1, "good": 2}


def test_folders_that_cannot_be_listed(spark, rows):
    tree = spark.createDataFrame([("b", "x", "y", True, False), ("b", "", "", True, True), ("b", "x", "f", False, False)],
                                 "backup_id string, rel_dir string, name string, is_dir boolean, readable boolean")
    assert rows(files.listing_issues(tree), "severity", "code", "subject") == [("ERROR", "LISTING_FAILED", "x/y")]


def test_outputs(spark, tree, tmp_path):
    df = spark.createDataFrame([("a", tree), ("b", str(tmp_path / "x/y/z"))],
                               "backup_id string, output_dir string")
    got = {r["backup_id"]: r for r in files.scan_outputs(df).collect()}
    assert got["a"]["entries"] == 4 and got["b"]["entries"] is None
    assert got["a"]["writable"] and got["b"]["writable"] and got["b"]["usable"] > 0
    assert got["a"]["device"] == got["b"]["device"]
    below = spark.createDataFrame([("f", f"{tree}/snapshot.shard1/zero/deeper")], "backup_id string, output_dir string")
    assert files.scan_outputs(below).first()["writable"] is False


def paths_of(spark, root):
    rows = [(f"{d}/{n}", os.path.getsize(f"{d}/{n}")) for d, _, names in os.walk(root) for n in names]
    return spark.createDataFrame(rows, "path string, length bigint"), dict(rows)


@pytest.mark.parametrize("range_bytes", [100, 1 << 20])
def test_copy(spark, tree, tmp_path, range_bytes):
    df, sizes = paths_of(spark, tree)
    target = str(tmp_path / "out")
    plan = df.withColumn("target", F.concat(F.lit(target), F.substring("path", len(tree) + 1, 10_000)))
    stale = target + "/snapshot.shard1/_0.fdt"
    os.makedirs(os.path.dirname(stale))
    with open(stale, "wb") as f:
        f.write(b"x" * 50_000)
    got = copy_files(plan, range_bytes).collect()
    assert len(got) == len(sizes)
    for r in got:
        with open(r["path"], "rb") as a, open(r["target"], "rb") as b:
            content = a.read()
            assert content == b.read()
        assert r["ok"] and r["length"] == len(content) and r["crc"] == zlib.crc32(content)


def test_copy_reports_missing_and_short(spark, tree, tmp_path):
    df = spark.createDataFrame(
        [("/nowhere/x", f"{tmp_path}/o/x", 10), (f"{tree}/snapshot.shard1/_0.fdt", f"{tmp_path}/o/y", 999)],
        "path string, target string, length bigint")
    assert [r["ok"] for r in copy_files(df).collect()] == [False, False]


def test_verification(spark, tree):
    bad = f"{tree}/snapshot.shard2/_3.fdt"
    with open(bad, "r+b") as f:
        f.seek(17)
        byte = f.read(1)
        f.seek(17)
        f.write(bytes([byte[0] ^ 1]))
    df, _ = paths_of(spark, tree)
    footers = files.read_tails(df).withColumn("checksum", stored_checksum(F.col("tail")))
    checked = verify_checksum(footers.join(file_crc(df, 8, 500).select("path", "crc"), "path"))
    got = {r["path"]: r["intact"] for r in checked.collect()}
    assert got.pop(f"{tree}/snapshot.shard1/zero") is None
    assert got.pop(bad) is False
    assert len(got) == 10 and all(got.values())


def test_texts(spark, tree):
    df = spark.createDataFrame([("b", f"{tree}/zk_backup/configs/_default/managed-schema"), ("b", "/nowhere")],
                               "backup_id string, path string")
    got = [r["content"] for r in files.read_texts(df).collect()]
    assert sorted(c is None for c in got) == [False, True]
    assert [c for c in got if c][0].startswith("<schema/>")


def test_repository(spark, tmp_path):
    root = str(tmp_path)
    long = [(root, "a/long.json", s * 2 ** 40 + i, f"<{s}:{i}:é>") for s in range(3) for i in range(2500)]
    parts = spark.createDataFrame(
        [*long, (root, "empty", 0, ""), (root, "b/one", 0, "x")],
        "root string, rel_path string, part bigint, body string").repartition(7)
    with open(f"{root}/empty", "wb") as f:
        f.write(b"stale")
    got = {r["rel_path"]: r for r in write_repository(parts).collect()}
    want = "".join(p[3] for p in long).encode()
    with open(f"{root}/a/long.json", "rb") as f:
        assert f.read() == want
    assert got["a/long.json"]["length"] == len(want) and got["a/long.json"]["parts"] == 7500
    assert os.path.getsize(f"{root}/empty") == 0 and got["b/one"]["length"] == 1


def test_running_total(spark):
    df = spark.createDataFrame([(k, o * 3, o % 7 + 1) for k in "ab" for o in range(5000)],
                               "k string, o bigint, v bigint")
    got = running_total(df, ["k"], "o", "v", "before", "total").filter("k = 'b'").orderBy("o").collect()
    seen = 0
    for r in got:
        assert r["before"] == seen
        seen += r["v"]
    assert {r["total"] for r in got} == {seen}


def test_numbering(spark):
    df = spark.range(10_000).select(((F.col("id") * 7919) % 10_007).alias("n"),
                                    (F.col("id") % 3).alias("other")).repartition(5)
    got = number_rows(df, ["n"]).orderBy("n").collect()
    assert [r["row_index"] for r in got] == list(range(10_000))
    assert set(got[0].asDict()) == {"n", "other", "row_index"}


def test_numbering_of_equal_rows(spark, monkeypatch):
    from searchshift.operators import numbering
    seen = []

    def keep(df, label):
        seen.append(df.cache())
        return seen[0]

    monkeypatch.setattr(numbering, "materialized", keep)
    df = spark.range(0, 30_000, 1, 6).select(F.lit("same").alias("n"), F.col("id"))
    got = number_rows(df, ["n"]).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(30_000))
    assert [r["id"] for r in got] == list(range(30_000))
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000


def test_batches(spark, tmp_path):
    made = spark.range(1, 1235).select(F.col("id"), F.concat(F.lit('n"ame '), "id").alias("name"),
                                       F.lit("2024-06-01T12:00:00Z").alias("at"))
    batches = records.batch_records(made, ["id"])
    assert [tuple(r) for r in records.batch_summary(batches).orderBy("batch").collect()] == [
        (0, 500, 1, 500), (1, 500, 501, 1000), (2, 234, 1001, 1234)]
    write_batches(batches, str(tmp_path)).collect()
    assert sorted(os.listdir(tmp_path)) == ["batch_0.json", "batch_1.json", "batch_2.json"]
    with open(tmp_path / "batch_2.json") as f:
        last = json.load(f)
    assert last == [{"id": i, "name": f'n"ame {i}', "at": "2024-06-01T12:00:00Z"} for i in range(1001, 1235)]
    loaded = records.load_records(spark, str(tmp_path), {"id": "long", "name": "text", "at": "date"})
    assert loaded.count() == 1234 and dict(loaded.dtypes)["at"] == "timestamp"
    assert loaded.select("id", "name").exceptAll(made.select("id", "name")).count() == 0

