"""File manifests and their roll-ups.

``manifest`` is (backup_id, shard_id, name, length, checksum, written_by, meta_hash);
``segments`` is (backup_id, shard_id, segment, max_doc, lucene_version, files), where an
empty commit is one row with a NULL segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import (checksum_value, format_bytes, meta_hash, stable_id,
                                stored_checksum, version_order, version_text)
from .issues import issue_rows
from .joins import join_parents

SHARD = ["backup_id", "shard_id"]


def footer_checksum(files: DataFrame) -> DataFrame:
    """Checksum stored in each file's footer, as text; the file is not re-read.

    ``files`` carries the last 16 bytes in ``tail``; a NULL checksum means that they
    are not a footer."""
    return files.withColumn("checksum", stored_checksum(F.col("tail")))


def footer_issues(footers: DataFrame) -> DataFrame:
    bad = footers.filter(F.col("checksum").isNull())
    return issue_rows(bad, "FOOTER_INVALID",
                      F.concat(F.lit("shard "), (F.col("shard_id") + 1).cast("string")), F.col("name"))


def verify_checksum(files: DataFrame) -> DataFrame:
    """Compare the stored checksum with the one computed over the file's bytes.

    ``files`` has ``checksum`` and ``crc``, the CRC-32 of all bytes before the stored
    value, from ``sinks.copy.file_crc``."""
    return files.withColumn("intact", checksum_value(F.col("checksum")) == F.col("crc"))


def checksum_issues(verified: DataFrame) -> DataFrame:
    """Files whose bytes do not have the checksum that they store."""
    return issue_rows(verified.filter(~F.col("intact")), "CHECKSUM_MISMATCH",
                      F.concat(F.lit("shard "), (F.col("shard_id") + 1).cast("string")), F.col("name"))


def with_meta_hash(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("meta_hash", meta_hash(
        F.col("name"), F.col("length"), F.col("checksum"), F.col("written_by")))


def shard_rollup(manifest: DataFrame, segments: DataFrame) -> DataFrame:
    """Documents, segments, files and bytes of each shard.

    ``max_docs`` counts deleted documents too. Both inputs are aggregated before they
    meet, so the join is one row to one row."""
    files = manifest.groupBy(*SHARD).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
    commits = segments.groupBy(*SHARD).agg(
        F.sum("max_doc").alias("max_docs"), F.count("segment").alias("segments"),
        F.max(version_order(F.col("lucene_version"))).alias("_version"))
    zero = F.lit(0).cast("bigint")
    return files.join(commits, SHARD, "full_outer").select(
        *SHARD,
        F.coalesce("max_docs", zero).alias("max_docs"),
        F.coalesce("segments", zero).alias("segments"),
        F.coalesce("files", zero).alias("files"),
        F.coalesce("bytes", zero).alias("bytes"),
        F.when(F.col("_version").isNotNull(), version_text(F.col("_version")))
        .alias("lucene_version"))


def conversion_rollup(shards: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Totals of each backup. ``skipped`` are the missing-file issues; a backup with
    any is not complete."""
    totals = shards.groupBy("backup_id").agg(
        F.count("*").alias("total_shards"), F.sum("files").alias("total_files"),
        F.sum("max_docs").alias("total_docs"), F.sum("bytes").alias("total_bytes"))
    totals = totals.withColumn(
        "metadata_files",
        rules.METADATA_FILES_FIXED + rules.METADATA_FILES_PER_SHARD * F.col("total_shards")
    ).withColumn("size", format_bytes(F.col("total_bytes")))
    if skipped is None:
        return totals.withColumn("complete", F.lit(True))
    holes = skipped.filter(F.col("code") == "FILE_MISSING").select("backup_id").distinct()
    return totals.join(holes.withColumn("_holes", F.lit(True)), "backup_id", "left").withColumn(
        "complete", F.col("_holes").isNull()).drop("_holes")


def shard_breakdown(shards: DataFrame, totals: DataFrame) -> DataFrame:
    """Per-shard lines of the backups that have more than one shard."""
    several = totals.filter(F.col("total_shards") > 1).select("backup_id")
    return join_parents(shards, several, ["backup_id"], spread=["shard_id"],
                        how="left_semi").withColumn(
        "size", format_bytes(F.col("bytes")))


def metadata_file_count(shards: DataFrame) -> DataFrame:
    """Files the metadata writer creates: five, and two per shard."""
    return shards.groupBy(*SHARD).agg(F.lit(1)).groupBy("backup_id").agg(
        (rules.METADATA_FILES_FIXED + rules.METADATA_FILES_PER_SHARD * F.count("*"))
        .alias("metadata_files"))


def commit_user_data(shards: DataFrame) -> DataFrame:
    """The eight entries written into each shard's commit."""
    last = F.greatest(F.lit(0).cast("bigint"), F.col("max_docs") - 1).cast("string")

    def unique(kind: str):
        return stable_id(kind, F.col("backup_id"), F.col("shard_id"))

    entries = F.create_map(
        F.lit("history_uuid"), unique("history"),
        F.lit("local_checkpoint"), last,
        F.lit("max_seq_no"), last,
        F.lit("min_retained_seqno"), F.lit("0"),
        F.lit("max_unsafe_auto_id_timestamp"), F.lit("-1"),
        F.lit("translog_uuid"), unique("log"),
        F.lit("translog_gen"), F.lit("1"),
        F.lit("min_translog_gen"), F.lit("1"),
    )
    return shards.select(*SHARD, entries.alias("user_data"))
