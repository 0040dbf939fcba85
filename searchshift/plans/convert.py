"""The whole conversion of many backups in one job.

Each stage hands over a table written to the shared scratch folder, so a folder is
listed once and a lost executor repeats one stage at most. A backup that fails a check
drops out with its issues; the others go on. Everything is written below a folder beside
the output, ``<output_dir>.staging-<run>``, checked there, and the files of the run's manifest are
moved to their place afterwards, the pointer file last. What fails stays in that folder; no
other run reads or publishes it.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import join_path, stable_id, version_order, version_text
from ..operators import detect, documents, manifest, mapping, validate
from ..operators.issues import issue_rows, union_issues
from ..operators.joins import join_parents
from ..session import materialized
from ..sinks.copy import RANGE_BYTES, copy_files
from ..sinks.repository import publish_files, write_repository
from ..sources import schema as schema_source
from ..sources.files import (listing_issues, read_documents, read_tails, read_texts, scan_files,
                             scan_outputs)
from ..sources.state import collection_state


class Conversion(NamedTuple):
    results: DataFrame   # one row per converted backup: totals, ids, replicas, complete
    shards: DataFrame    # one row per shard of them
    issues: DataFrame    # everything found, of all backups
    written: DataFrame   # metadata files written (root, rel_path, length, parts, ok)
    commits: DataFrame   # the entries that each shard's commit has to carry


def _texts(inventory: DataFrame, roots: DataFrame, candidates: tuple[str, ...]) -> DataFrame:
    """Content of the candidate files that exist: (backup_id, rank, content)."""
    path = join_path(F.col("rel_dir"), F.col("name"))
    ranked = F.array(*[F.lit(c) for c in candidates])
    found = inventory.filter(path.isin(*candidates)).select(
        "backup_id", F.array_position(ranked, path).alias("rank"), path.alias("rel_path"))
    return read_texts(found.join(roots, "backup_id").select(
        "backup_id", "rank", F.concat_ws("/", "root", "rel_path").alias("path")))


def _mapping_parts(plan: DataFrame, roots: DataFrame):
    """Mapping document parts of the planned backups, and what their schemas raise."""
    paths = plan.filter(F.col("schema_path").isNotNull()).join(roots, "backup_id").select(
        "backup_id", F.concat_ws("/", "root", "schema_path").alias("path"))
    declarations = materialized(schema_source.schema_declarations(read_documents(paths)), "schemas")
    mapped = mapping.map_field_types(
        mapping.visible_fields(schema_source.schema_fields(declarations)),
        schema_source.schema_types(declarations))
    broken = declarations.filter(F.col("kind") == "error")
    without = plan.filter(F.col("schema_path").isNull())
    issues = union_issues(
        issue_rows(broken, "SCHEMA_UNREADABLE", F.lit(""), F.col("value")),
        issue_rows(without, "SCHEMA_MISSING", F.lit(""), F.lit("")),
        mapping.mapping_issues(mapped))
    return mapping.build_mapping(mapping.final_mapping(mapped)), issues


def _referenced(segments: DataFrame, inventory: DataFrame, shards: DataFrame) -> DataFrame:
    """Files of each shard that its commit refers to, the commit file among them:
    (backup_id, shard_id, name, written_by). All files of a shard have the version of its
    commit, whatever wrote their segment."""
    keys = ["backup_id", "shard_id"]
    versions = segments.groupBy(*keys).agg(
        version_text(F.max(version_order(F.col("lucene_version")))).alias("written_by"))
    commits = detect.latest_commit(inventory).join(shards, ["backup_id", "dir"]).select(
        *keys, F.col("commit_file").alias("name"))
    listed = segments.select(*keys, F.explode("files").alias("name"))
    return join_parents(listed.unionByName(commits).distinct(), versions, keys, spread=["name"])


def _staged(run: str, column: str = "output_dir") -> Column:
    return F.concat(F.rtrim(F.col(column), F.lit("/")), F.lit(f".staging-{run}"))


def convert_backups(backups: DataFrame, segments: DataFrame, now_ms: int,
                    range_bytes: int = RANGE_BYTES, run: str | None = None) -> Conversion:
    """Convert ``backups`` (backup_id, input_dir, output_dir, index_name, replicas).

    ``segments`` holds the commit contents of the planned shards, with ``replicas`` < 0
    meaning that the source decides. ``now_ms`` is the time written to the documents. ``run`` names the
    attempt: every attempt writes to staging folders of its own and publishes exactly the files in its
    own manifest, so nothing that an earlier attempt left is published with them."""
    run = run or uuid.uuid4().hex[:12]
    clashes = materialized(validate.shared_targets(backups), "clashes")
    backups = materialized(validate.validation_gate(backups, clashes), "backups")
    segments = materialized(segments, "segments")
    roots = backups.select("backup_id", F.col("input_dir").alias("root"))
    inventory = materialized(scan_files(roots).drop("root"), "inventory")
    formats = materialized(detect.classify_format(inventory), "formats")
    absent = issue_rows(
        backups.join(formats, "backup_id", "left_anti"), "NOT_A_DIRECTORY", F.lit(""), F.lit(""))

    # plan
    states = _texts(inventory, roots, rules.STATE_CANDIDATES).withColumnRenamed("rank", "dir_rank")
    plan = detect.conversion_plan(
        formats, detect.resolve_schema_path(inventory), collection_state(states)
    ).drop("replicas", "replica_source").join(
        backups.select("backup_id", "index_name", "output_dir",
                       F.col("replicas").alias("_asked")), "backup_id")
    plan = materialized(detect.resolve_replicas(plan, "_asked").drop("_asked"), "plan")
    shards = materialized(detect.plan_shards(
        formats, detect.shard_dirs(inventory), detect.standalone_index(inventory)), "shards")

    # check the input
    outputs = materialized(scan_outputs(plan), "outputs")
    shard_entries = join_parents(
        inventory.filter(~F.col("is_dir")).select(
            "backup_id", F.col("rel_dir").alias("dir"), "name", "length"),
        shards, ["backup_id", "dir"], spread=["name"])
    shard_entries = materialized(shard_entries, "entries")
    planned = join_parents(segments, plan.select("backup_id"), ["backup_id"],
                           spread=["shard_id", "segment"], how="left_semi")
    missing = materialized(detect.missing_files(planned, shard_entries), "missing")
    before = materialized(union_issues(
        clashes, absent, listing_issues(inventory), detect.commit_name_issues(inventory),
        detect.detection_issues(formats), detect.unmatched_shard_dirs(inventory),
        validate.input_present(plan, shards, inventory), validate.output_state(outputs),
        validate.segment_health(shards, segments),
        validate.disk_space(validate.input_bytes(inventory, shards), outputs), missing), "issues")
    accepted = validate.validation_gate(plan, before)
    mapping_parts, schema_issues = _mapping_parts(accepted, roots)
    # before a byte is copied
    schema_issues = materialized(schema_issues, "issues")
    accepted = materialized(validate.validation_gate(accepted, schema_issues), "accepted")

    # copy the live files and describe them
    targets = accepted.select("backup_id", _staged(run).alias("output_dir")).join(roots, "backup_id")
    referenced = _referenced(segments, inventory, shards)
    live = join_parents(
        shard_entries.join(referenced, ["backup_id", "shard_id", "name"]), targets,
        ["backup_id"], spread=["shard_id", "name"]).select(
        "backup_id", "shard_id", "name", "length", "written_by",
        F.concat_ws("/", "root", F.when(F.col("dir") != "", F.col("dir")), "name").alias("path"),
        F.concat_ws("/", "output_dir", F.lit("indices"), stable_id("index", F.col("backup_id")),
                    F.col("shard_id").cast("string"), "name").alias("target"))
    live = materialized(live, "live")
    copied = materialized(copy_files(live, range_bytes), "copied")
    uncopied = live.join(copied.filter(~F.col("ok")), ["path", "target"], "left_semi")
    footers = materialized(manifest.footer_checksum(read_tails(live)), "footers")
    # the copy has read every byte, so comparing with what the file stores costs no look
    verified = manifest.verify_checksum(footers.join(
        copied.where("ok").select("path", "target", F.col("lead_crc").alias("crc")), ["path", "target"]))
    during = materialized(union_issues(
        schema_issues, manifest.footer_issues(footers), manifest.checksum_issues(verified),
        issue_rows(uncopied, "COPY_FAILED",
                   F.concat(F.lit("shard "), (F.col("shard_id") + 1).cast("string")), F.col("name"))),
        "issues")
    described = manifest.with_meta_hash(
        validate.validation_gate(footers, during)).select(
        "backup_id", "shard_id", "name", "length", "checksum", "written_by", "meta_hash")
    described = materialized(described, "manifest")

    # roll up and write the metadata
    going = validate.validation_gate(accepted, during).select("backup_id")
    rollup = join_parents(shards.select("backup_id", "shard_id"), going, ["backup_id"],
                          spread=["shard_id"], how="left_semi").join(
        manifest.shard_rollup(described, segments), ["backup_id", "shard_id"])
    rollup = materialized(rollup, "rollup")
    totals = manifest.conversion_rollup(rollup, missing).join(
        plan.select("backup_id", "format", "index_name", "output_dir", "replicas",
                    "replica_source"), "backup_id")
    totals = materialized(documents.with_conversion_ids(totals), "totals")
    chunks = materialized(documents.file_chunks(described), "chunks")
    named = join_parents(rollup, totals.select("backup_id", "index_name"), ["backup_id"],
                         spread=["shard_id"])
    parts = (
        documents.snapshot_doc(totals, now_ms)
        .unionByName(documents.global_doc(totals))
        .unionByName(documents.repo_index_doc(totals, rollup))
        .unionByName(documents.repo_latest(totals))
        .unionByName(documents.index_doc(
            totals, rollup, mapping_parts.join(totals, "backup_id", "left_semi")))
        .unionByName(documents.shard_snapshot_doc(chunks, named, now_ms))
        .unionByName(documents.shard_index_doc(chunks, rollup))
    )
    places = totals.select("backup_id", "output_dir", _staged(run).alias("root"))
    rooted = join_parents(parts, places.select("backup_id", "root"), ["backup_id"], spread=["rel_path", "part"])
    written = materialized(join_parents(write_repository(rooted), places, ["root"], spread=["rel_path"]), "written")

    # check what was written and move it to its place
    produced = materialized(scan_files(places.select("backup_id", "root")).drop("root"), "produced")
    checked = materialized(union_issues(
        issue_rows(written.where("not ok"), "WRITE_FAILED", F.col("rel_path"), F.lit("")),
        validate.repo_files(produced, rollup), validate.index_latest_size(produced),
        validate.index_dirs(produced, rollup), validate.shard_files(produced, rollup)), "issues")
    ready = validate.validation_gate(places, checked).select(
        "backup_id", F.col("root").alias("staged"), F.col("output_dir").alias("target"))
    copies = live.join(described.select("backup_id", "shard_id", "name"), ["backup_id", "shard_id", "name"], "left_semi")
    own = copies.select("backup_id", F.col("target").alias("path"), "length").unionByName(
        written.select("backup_id", F.concat_ws("/", "root", "rel_path").alias("path"), "length"))
    files = join_parents(own, ready, ["backup_id"], spread=["path"]).select(
        "backup_id", "staged", "target", F.expr("substring(path, length(staged) + 2)").alias("rel_path"), "length")
    moved = materialized(publish_files(files, rules.REPO_LATEST), "moved")
    after = union_issues(checked, issue_rows(moved.where("not ok"), "WRITE_FAILED", F.lit(""), F.lit("")))
    return Conversion(
        results=validate.validation_gate(totals, after),
        shards=manifest.shard_breakdown(rollup, totals),
        issues=union_issues(before, during, after),
        written=written.select(F.col("output_dir").alias("root"), "rel_path", "length", "parts", "ok"),
        commits=manifest.commit_user_data(rollup))

