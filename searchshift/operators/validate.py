"""Checks before and after a conversion. Each returns issue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..session import materialized
from ..functions.values import format_bytes, join_path, version_fits, version_order, version_part, version_text
from .issues import emit, issue_rows, union_issues, when
from .joins import join_groups, join_parents, join_shuffled


def _shard_label() -> Column:
    """Shards are numbered from 1 in all messages."""
    return F.concat(F.lit("shard "), (F.col("shard_id") + 1).cast("string"))


def _folder_label() -> Column:
    """The same for a shard known by its folder, which is numbered from 0."""
    return F.concat(F.lit("shard "), (F.col("dir").try_cast("bigint") + 1).cast("string"))


def input_present(planned: DataFrame, shards: DataFrame, inventory: DataFrame) -> DataFrame:
    """Input directory and planned shard directories exist and can be read.

    ``planned`` lists the backups, ``shards`` their planned shards. Where the input
    directory itself is missing its shards are not reported again."""
    dirs = inventory.filter(F.col("is_dir")).select(
        "backup_id", join_path(F.col("rel_dir"), F.col("name")).alias("dir"), "readable")
    roots = dirs.filter(F.col("dir") == "").select("backup_id", "readable")
    checked = join_shuffled(planned.select("backup_id"), roots, ["backup_id"], "left")
    missing = checked.filter(F.col("readable").isNull()).select("backup_id")
    shard_state = join_shuffled(shards, dirs, ["backup_id", "dir"], "left").filter(
        F.col("readable").isNull() | ~F.col("readable"))
    doubtful = join_groups(shard_state, missing, ["backup_id"], spread=["shard_id"], how="left_anti")
    nothing = F.lit("")
    return union_issues(
        emit(checked,
             when(F.col("readable").isNull(), "INPUT_MISSING", nothing, nothing),
             when(~F.col("readable"), "INPUT_UNREADABLE", nothing, nothing)),
        emit(doubtful,
             when(F.col("readable").isNull(), "SHARD_DIR_MISSING", _shard_label(), F.col("dir")),
             when(~F.col("readable"), "SHARD_DIR_UNREADABLE", _shard_label(), F.col("dir"))),
    )


def shared_targets(backups: DataFrame) -> DataFrame:
    """Backups that occur twice, and outputs that meet another backup's folders.

    ``backups`` is (backup_id, input_dir, output_dir). An output may be neither the same
    as, nor inside, nor around another output, and neither inside nor around any input.
    Folders meet by equal paths among their parents, so nothing is compared pairwise."""
    def clean(path: Column) -> Column:
        return F.concat(F.lit("/"), F.array_join(F.filter(F.split(path, "/+"), lambda p: ~p.isin("", ".")), "/"))

    def with_parents(folders: DataFrame) -> DataFrame:
        names = F.split("folder", "/")
        return folders.select("*", F.explode(F.transform(
            F.sequence(F.lit(1), F.size(names)), lambda n: F.array_join(F.slice(names, 1, n), "/"))).alias("parent"))

    twice = backups.groupBy("backup_id").agg(F.count("*").alias("n")).where("n > 1")
    folders = backups.select("backup_id", F.explode(F.array(
        F.struct(F.lit("in").alias("side"), clean(F.col("input_dir")).alias("folder")),
        F.struct(F.lit("out").alias("side"), clean(F.col("output_dir")).alias("folder")))).alias("f")).select(
        "backup_id", "f.*").distinct()
    # one row per folder, so that a folder that all share stays one row
    used = folders.groupBy("folder").agg(
        F.min(F.when(F.col("side") == "out", F.col("backup_id"))).alias("first"),
        F.max(F.when(F.col("side") == "out", F.col("backup_id"))).alias("last"),
        F.max(F.col("side") == "in").alias("is_input"))
    mine = with_parents(folders)
    # above: a folder whose parent, or which itself, is in use by another
    met = mine.join(used.withColumnRenamed("folder", "parent"), "parent")
    other = (F.col("first") != F.col("backup_id")) | (F.col("last") != F.col("backup_id"))
    inner = met.where((F.col("side") == "out") & (F.coalesce(other, F.lit(False)) | F.col("is_input"))).select("backup_id")
    # below: an output that is a parent of another's folder, or of any input
    around = with_parents(used).where("parent <> folder").groupBy("parent").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("is_input").alias("is_input"))
    outer = folders.where("side = 'out'").join(around.withColumnRenamed("parent", "folder"), "folder").where(
        F.coalesce(other, F.lit(False)) | F.col("is_input")).select("backup_id")
    bad = inner.unionByName(outer).distinct().join(
        backups.groupBy("backup_id").agg(F.min("output_dir").alias("output_dir")), "backup_id")
    return issue_rows(twice, "DUPLICATE_BACKUP", F.lit(""), F.col("n")).unionByName(
        issue_rows(bad, "OUTPUT_SHARED", F.col("output_dir"), F.lit("")))


def output_state(outputs: DataFrame) -> DataFrame:
    """Output directory writable and empty.

    ``outputs`` is (backup_id, output_dir, writable, entries): whether the nearest
    existing ancestor can be written, and the entries already there (NULL if the
    directory does not exist)."""
    return emit(
        outputs,
        when(~F.col("writable"), "OUTPUT_NOT_WRITABLE", F.col("output_dir"), F.lit("")),
        when(F.col("entries") > 0, "OUTPUT_NOT_EMPTY", F.col("output_dir"), F.col("entries")),
    )


def segment_health(shards: DataFrame, segments: DataFrame) -> DataFrame:
    """Age of the index library, empty shards, unreadable commits, versions too large to be told apart.

    A planned shard without any commit row counts as unreadable; ``segments`` may
    carry an ``unreadable`` flag."""
    flag = F.col("unreadable") if "unreadable" in segments.columns else F.lit(False)
    commits = segments.groupBy("backup_id", "shard_id").agg(
        F.max(flag).alias("unreadable"),
        F.max(version_order(F.col("lucene_version"))).alias("_version"),
        F.max(~version_fits(F.col("lucene_version"))).alias("_wide"),
        F.count("segment").alias("segments"),
        F.coalesce(F.sum("max_doc"), F.lit(0)).alias("max_docs"))
    state = (
        shards.select("backup_id", "shard_id")
        .join(commits, ["backup_id", "shard_id"], "left")
        .withColumn("readable", ~F.coalesce("unreadable", F.lit(True)))
        .withColumn("version", version_text(F.col("_version")))
        .withColumn("major", version_part(F.col("version"), 0))
    )
    ok, label = F.col("readable"), _shard_label()
    return emit(
        state,
        when(ok & (F.col("major") < rules.MINIMUM_MAJOR), "LIBRARY_TOO_OLD", label,
             F.col("version")),
        when(ok & (F.col("major") == rules.MINIMUM_MAJOR), "LIBRARY_OLD", label, F.col("version")),
        when(ok & (F.col("segments") == 0), "NO_SEGMENTS", label, F.lit("")),
        when(ok & (F.col("max_docs") == 0), "NO_DOCUMENTS", label, F.lit("")),
        when(~ok, "COMMIT_UNREADABLE", label, F.lit("")),
        when(ok & F.col("_wide"), "VERSION_RANGE", label, F.lit("")),
    )


def input_bytes(inventory: DataFrame, shards: DataFrame) -> DataFrame:
    """Bytes below each backup's planned shard directories; an unknown size counts as 0.

    Shard directories lie directly in the root, or are the root itself, which takes in
    everything. Files are summed by top-level directory before they meet the plan, and
    they are read once for both."""
    tops = inventory.filter(~F.col("is_dir")).groupBy(
        "backup_id", F.split_part("rel_dir", F.lit("/"), F.lit(1)).alias("dir")
    ).agg(F.sum(F.coalesce("length", F.lit(0))).alias("bytes"))
    planned = shards.filter(F.col("dir") != "").select("backup_id", "dir").distinct().withColumn("inside", F.lit(True))
    totals = join_shuffled(tops, planned, ["backup_id", "dir"], "left").groupBy("backup_id").agg(
        F.sum(F.when(F.col("inside"), F.col("bytes"))).alias("inside"), F.sum("bytes").alias("all"))
    whole = shards.filter(F.col("dir") == "").select("backup_id").distinct().withColumn("whole", F.lit(True))
    return join_shuffled(totals, whole, ["backup_id"], "left").filter(
        F.col("inside").isNotNull() | F.col("whole")
    ).select("backup_id", (F.coalesce("inside", F.lit(0)) + F.when(F.col("whole"), F.col("all")).otherwise(F.lit(0)))
             .cast("bigint").alias("input_bytes"))


def disk_space(sizes: DataFrame, volumes: DataFrame) -> DataFrame:
    """Warn where 1.1 times the input does not fit. ``volumes`` is (backup_id, usable,
    device); backups whose output goes to one device share its space, so all of them are
    warned if their sum does not fit."""
    required = (F.col("input_bytes") * F.lit(rules.DISK_FACTOR)).cast("bigint")
    wanted = join_shuffled(sizes, volumes.select("backup_id", "usable", "device"), ["backup_id"])
    # written down, one narrow row per backup, as it is read twice
    wanted = materialized(wanted.select("backup_id", "usable", "device", required.alias("required")), "wanted")
    # one narrow row per device, whatever the number of its backups
    devices = wanted.filter(F.col("device").isNotNull()).groupBy("device").agg(
        F.sum("required").alias("required"), F.min("usable").alias("usable"))
    full = devices.filter(F.col("usable") < F.col("required"))
    short = join_groups(wanted.select("backup_id", "device"), full, ["device"], spread=["backup_id"])
    return issue_rows(
        short, "LOW_DISK_SPACE", F.lit(""),
        F.concat(F.lit("need "), format_bytes(F.col("required")), F.lit(", have "),
                 format_bytes(F.col("usable"))))


def validation_gate(rows: DataFrame, issues: DataFrame) -> DataFrame:
    """Backups, or rows of backups, that may go on: any error stops a backup, warnings
    do not."""
    failed = issues.filter(F.col("severity") == "ERROR").select("backup_id").distinct()
    return join_parents(rows, failed, ["backup_id"], spread=rows.columns, how="left_anti")


# --- output tree ----------------------------------------------------------------------


def _is_data(prefix: str) -> Column:
    return F.col("name").startswith(prefix) & F.col("name").endswith(".dat")


def _any(condition: Column) -> Column:
    return F.coalesce(F.max(condition), F.lit(False))


def _of_each(expected: DataFrame, flags: DataFrame) -> DataFrame:
    """``flags`` of every expected backup; one without any entry has none of what is asked."""
    found = join_shuffled(expected.select("backup_id").distinct(), flags, ["backup_id"], "left")
    return found.select("backup_id", *[
        F.coalesce(c, F.lit(False)).alias(c) for c in flags.columns if c != "backup_id"])


def repo_files(outputs: DataFrame, expected: DataFrame) -> DataFrame:
    """Repository-level files of every expected backup (backup_id). ``outputs`` is an
    inventory of the output trees; a repository that is not there lacks all of them."""
    here = F.col("rel_dir") == ""
    flags = _of_each(expected, outputs.filter(here).groupBy("backup_id").agg(
        _any(F.col("name") == rules.REPO_INDEX).alias("index"),
        _any(F.col("name") == rules.REPO_LATEST).alias("latest"),
        _any(_is_data("snap-")).alias("snap"),
        _any(_is_data("meta-")).alias("meta")))
    nothing = F.lit("")
    return emit(
        flags,
        when(~F.col("index"), "REPO_INDEX_MISSING", F.lit(rules.REPO_INDEX), nothing),
        when(~F.col("latest"), "REPO_LATEST_MISSING", F.lit(rules.REPO_LATEST), nothing),
        when(~F.col("snap"), "REPO_SNAPSHOT_MISSING", F.lit("snap-*.dat"), nothing),
        when(~F.col("meta"), "REPO_METADATA_MISSING", F.lit("meta-*.dat"), nothing),
    )


def index_latest_size(outputs: DataFrame) -> DataFrame:
    """The pointer file holds exactly one eight-byte number."""
    wrong = outputs.filter(
        (F.col("rel_dir") == "") & (F.col("name") == rules.REPO_LATEST)
        & (F.col("length") != rules.REPO_LATEST_BYTES))
    return issue_rows(wrong, "REPO_LATEST_SIZE", F.col("name"), F.col("length"))


def pick_index_dir(outputs: DataFrame) -> DataFrame:
    """Index directory to check: the lowest name, with the number of candidates."""
    return (
        outputs.filter(F.col("is_dir") & (F.col("rel_dir") == "indices"))
        .groupBy("backup_id")
        .agg(F.min("name").alias("index_dir"), F.count("*").alias("candidates"))
    )


def _inside_index(outputs: DataFrame) -> DataFrame:
    """Entries below any index directory, with their folder inside it."""
    return outputs.filter(F.col("rel_dir").startswith("indices/")).withColumn(
        "index_dir", F.split_part("rel_dir", F.lit("/"), F.lit(2))).withColumn(
        "inside", F.expr("substring(rel_dir, length('indices//') + length(index_dir) + 1)"))


def index_dirs(outputs: DataFrame, shards: DataFrame) -> DataFrame:
    """Index directory, its metadata, and one directory per expected shard.

    ``shards`` is (backup_id, shard_id), the shards the conversion planned; a backup of
    theirs without any entry has no index directory, and its shards are missing."""
    facts = _of_each(shards, outputs.filter(F.col("rel_dir") == "").groupBy("backup_id").agg(
        _any(F.col("is_dir") & (F.col("name") == "indices")).alias("has_indices")))
    picked = pick_index_dir(outputs)
    top = _inside_index(outputs).filter(F.col("inside") == "")
    metadata = top.filter(_is_data("meta-")).select("backup_id", "index_dir").distinct(
        ).withColumn("has_metadata", F.lit(True))
    state = join_shuffled(
        join_shuffled(facts, picked, ["backup_id"], "left"), metadata, ["backup_id", "index_dir"], "left"
    ).withColumn("has_metadata", F.coalesce("has_metadata", F.lit(False)))
    usable = F.col("index_dir").isNotNull()
    nothing = F.lit("")
    level = emit(
        state,
        when(~F.col("has_indices"), "INDICES_DIR_MISSING", F.lit("indices"), nothing),
        when(F.col("has_indices") & ~usable, "INDEX_DIR_MISSING", F.lit("indices"), nothing),
        when(F.col("candidates") > 1, "INDEX_DIR_MULTIPLE", F.col("index_dir"),
             F.col("candidates")),
        when(usable & ~F.col("has_metadata"), "INDEX_METADATA_MISSING", F.col("index_dir"),
             nothing),
    )
    present = top.filter("is_dir").select("backup_id", "index_dir", F.col("name").alias("dir"))
    absent = join_shuffled(
        join_groups(shards.select("backup_id", F.col("shard_id").cast("string").alias("dir")),
                    picked.select("backup_id", "index_dir"), ["backup_id"], spread=["dir"], how="left"),
        present, ["backup_id", "index_dir", "dir"], "left_anti")
    return level.unionByName(
        issue_rows(absent, "OUTPUT_SHARD_MISSING", _folder_label(), nothing))


def shard_files(outputs: DataFrame, shards: DataFrame) -> DataFrame:
    """Files of each expected shard directory that exists.

    Files are reduced to one row per directory before anything is joined."""
    snap = _is_data("snap-")
    index = F.col("name").startswith("index-")
    # the directory's own row keeps an empty shard directory in view
    own = F.col("is_dir") & (F.col("inside") == "")
    inside = _inside_index(outputs).filter(
        own | ((F.col("inside") != "") & ~F.col("inside").contains("/")))
    flags = inside.groupBy(
        "backup_id", "index_dir",
        F.when(own, F.col("name")).otherwise(F.col("inside")).alias("dir")
    ).agg(
        _any(~own & snap).alias("snap"), _any(~own & index & ~snap).alias("index"),
        F.count_if(~own & ~snap & ~index).alias("others"))
    expected = shards.select("backup_id", F.col("shard_id").cast("string").alias("dir"))
    label, nothing = _folder_label(), F.lit("")
    return emit(
        join_groups(join_shuffled(flags, expected, ["backup_id", "dir"], "left_semi"),
                    pick_index_dir(outputs).select("backup_id", "index_dir"),
                    ["backup_id", "index_dir"], spread=["dir"], how="left_semi"),
        when(~F.col("snap"), "SHARD_SNAPSHOT_MISSING", label, nothing),
        when(~F.col("index"), "SHARD_INDEX_MISSING", label, nothing),
        when(F.col("others") == 0, "SHARD_FILES_MISSING", label, nothing),
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues by code in check order, with totals: NULL code is a severity's total,
    NULL severity the grand total."""
    order = F.create_map(*[F.lit(v) for pair in rules.CHECK_ORDER.items() for v in pair])
    per_backup = issues.groupBy("severity", "code", "backup_id").agg(F.count("*").alias("n"))
    return (
        per_backup.rollup("severity", "code")
        .agg(F.sum("n").alias("issues"), F.count_distinct("backup_id").alias("backups"))
        .withColumn("check_order", F.try_element_at(order, F.col("code")))
    )


def report(issues: DataFrame) -> DataFrame:
    """Issues of every backup with their place in the check order, errors flagged."""
    order = F.create_map(*[F.lit(v) for pair in rules.CHECK_ORDER.items() for v in pair])
    return issues.withColumn("check_order", F.element_at(order, F.col("code"))).withColumn(
        "is_error", F.col("severity") == "ERROR")
