"""Snapshot metadata documents as ordered text parts.

A document is the concatenation of its parts: (backup_id, rel_path, part, body). The
parts of a list hold a bounded number of entries each, so a shard with most of the
files never becomes one row, and the writer can place parts independently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import json_text, meta_hash, stable_id
from .joins import join_parents

HASH_BITS = 32
SECTION = 2 ** 40
FILES_PER_PART = 1000


def text_hash(text: Column) -> Column:
    """Evenly spread place of a text in 0 .. 2^32-1."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def _section(number: int, chunk: Column | int = 0) -> Column:
    within = chunk if isinstance(chunk, Column) else F.lit(chunk)
    return (F.lit(number * SECTION) + within).cast("bigint").alias("part")


def _collect(chunked: DataFrame, keys: list[str], bodies: dict[str, Column]) -> DataFrame:
    """Comma-joined bodies of each chunk in (place, name) order. Every chunk but the
    first of its list starts with a comma; ``is_first`` and ``is_last`` mark the ends."""
    # Repartitioned by chunk: the preceding join leaves all rows of a list together.
    made = [body.alias(name) for name, body in bodies.items()]
    lists = chunked.repartition(*keys, "chunk").groupBy(*keys, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("place", "name", *made))).alias("_entries"),
        F.max("first").alias("first"), F.max("last").alias("last"))
    lead = F.when(F.col("chunk") == F.col("first"), F.lit("")).otherwise(F.lit(","))
    return lists.select(
        *keys, "chunk", (F.col("chunk") == F.col("first")).alias("is_first"),
        (F.col("chunk") == F.col("last")).alias("is_last"),
        *[F.concat(lead, F.array_join(f"_entries.{body}", ",")).alias(body) for body in bodies])


def list_parts(entries: DataFrame, keys: list[str], size: int,
               bodies: dict[str, Column] | None = None) -> DataFrame:
    """Lists of named entries cut into chunks: keys + (chunk, is_first, is_last, bodies).

    ``entries`` is keys + (place, name, ...) with names unique in a list and
    ``place`` their ``text_hash``. Equal stretches of the hash space hold about
    ``size`` entries each. ``bodies`` are the texts of an entry, made of its columns (by
    default its ``body``) after the entries were moved: a text takes more room than they do.
    """
    bodies = bodies or {"body": F.col("body")}
    facts = [c for c in entries.columns if c not in (*keys, "place", "name")]
    stats = entries.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("place").alias("_low"),
                                         F.max("place").alias("_high"))
    chunks = F.ceil(F.col("_n") / size)

    def chunk_of(place: Column) -> Column:
        return F.shiftright(place * chunks, HASH_BITS)

    chunked = join_parents(entries, stats, keys, spread=["place"]).select(
        *keys, "place", "name", *facts,
        chunk_of(F.col("place")).alias("chunk"), chunk_of(F.col("_low")).alias("first"),
        chunk_of(F.col("_high")).alias("last"))
    return _collect(chunked, keys, bodies)


def numbered_parts(entries: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Lists in the order of a dense number from 0, such as shard ids."""
    chunked = entries.withColumn("chunk", F.floor(F.col("place") / size)).withColumn(
        "first", F.lit(0).cast("bigint")).withColumn("last", F.lit(None).cast("bigint"))
    return _collect(chunked, keys, {"body": F.col("body")})


# --- identifiers -----------------------------------------------------------------


def with_conversion_ids(conversions: DataFrame) -> DataFrame:
    """Identifiers of a conversion, derived from the backup so that reruns agree."""
    return (
        conversions
        .withColumn("snapshot_id", stable_id("snapshot", F.col("backup_id")))
        .withColumn("index_id", stable_id("index", F.col("backup_id")))
        .withColumn("metadata_id", stable_id("metadata", F.col("backup_id")))
    )


def with_shard_ids(shards: DataFrame) -> DataFrame:
    """Identifiers of each shard: generation, allocation, history, log."""
    def of(kind: str) -> Column:
        return stable_id(kind, F.col("backup_id"), F.col("shard_id"))

    return (
        shards.withColumn("generation_id", of("generation"))
        .withColumn("allocation_id", of("allocation"))
        .withColumn("history_id", of("history"))
        .withColumn("log_id", of("log"))
    )


def _snapshot_name() -> Column:
    return F.concat(F.col("index_name"), F.lit("-snapshot"))


def _snapshot_id() -> Column:
    return stable_id("snapshot", F.col("backup_id"))


def _index_id() -> Column:
    return stable_id("index", F.col("backup_id"))


def _index_name(source: DataFrame) -> Column:
    """Index name: given by the input, else the backup id in lower case."""
    return F.col("index_name") if "index_name" in source.columns else F.lower("backup_id")


def _document(df: DataFrame, path: Column, part: Column, body: Column) -> DataFrame:
    return df.select("backup_id", path.alias("rel_path"), part, body.alias("body"))


# --- documents of a whole conversion ---------------------------------------------


def snapshot_doc(conversions: DataFrame, now_ms: int) -> DataFrame:
    """Snapshot description: (backup_id, index_name, total_shards) -> one part each.

    The time is a parameter, so that the result depends on the input alone."""
    body = F.to_json(F.struct(F.struct(
        _snapshot_name().alias("name"),
        _snapshot_id().alias("uuid"),
        F.lit(rules.TARGET_VERSION_ID).alias("version_id"),
        F.lit(False).alias("remote_store_index_shallow_copy"),
        F.array("index_name").alias("indices"),
        F.array().cast("array<string>").alias("data_streams"),
        F.lit("SUCCESS").alias("state"),
        F.lit(False).alias("include_global_state"),
        F.lit(None).cast("string").alias("metadata"),
        F.lit(now_ms).cast("bigint").alias("start_time"),
        F.lit(now_ms).cast("bigint").alias("end_time"),
        F.col("total_shards").alias("total_shards"),
        F.col("total_shards").alias("successful_shards"),
        F.array().cast("array<string>").alias("failures"),
    ).alias("snapshot")), {"ignoreNullFields": "false"})
    path = F.concat(F.lit("snap-"), _snapshot_id(), F.lit(".dat"))
    return _document(conversions, path, _section(0), body)


def global_doc(conversions: DataFrame) -> DataFrame:
    """Global metadata: the cluster goes by the snapshot's identifier."""
    body = F.to_json(F.struct(F.struct(
        F.lit(1).alias("version"), _snapshot_id().alias("cluster_uuid")).alias("meta-data")))
    path = F.concat(F.lit("meta-"), _snapshot_id(), F.lit(".dat"))
    return _document(conversions, path, _section(0), body)


def repo_index_doc(conversions: DataFrame, shards: DataFrame,
                   shards_per_part: int = FILES_PER_PART) -> DataFrame:
    """Repository index: snapshots, indices with ordered shard generations, and the
    metadata identifiers."""
    key = F.concat(_index_id(), F.lit("-_na_-1-1-1"))
    snapshot = F.to_json(F.struct(
        _snapshot_name().alias("name"), _snapshot_id().alias("uuid"), F.lit(1).alias("state"),
        F.create_map(_index_id(), key).alias("index_metadata_lookup"),
        F.lit(rules.TARGET_VERSION).alias("version")))
    opening = F.concat(
        F.lit('{"snapshots":['), snapshot, F.lit('],"indices":{'), json_text(F.col("index_name")),
        F.lit(':{"id":"'), _index_id(), F.lit('","snapshots":["'), _snapshot_id(),
        F.lit('"],"shard_generations":['))
    closing = F.concat(
        F.lit(']}},"index_metadata_identifiers":'),
        F.to_json(F.create_map(key, stable_id("metadata", F.col("backup_id")))), F.lit("}"))
    path = F.lit(rules.REPO_INDEX)
    generations = numbered_parts(
        shards.select("backup_id", F.col("shard_id").alias("place"), F.lit("").alias("name"),
                      F.concat(F.lit('"'), stable_id("generation", F.col("backup_id"),
                                                     F.col("shard_id")), F.lit('"')).alias("body")),
        ["backup_id"], shards_per_part)
    return reduce(DataFrame.unionByName, [
        _document(conversions, path, _section(0), opening),
        _document(generations, path, _section(1, F.col("chunk")), F.col("body")),
        _document(conversions, path, _section(2), closing),
    ])


def repo_latest(conversions: DataFrame) -> DataFrame:
    """Pointer to the newest repository index: eight zero bytes, big-endian 0."""
    return _document(conversions, F.lit(rules.REPO_LATEST), _section(0),
                     F.decode(F.unhex(F.lpad(F.hex(F.lit(0)), 16, "0")), "US-ASCII"))


def index_doc(conversions: DataFrame, shards: DataFrame, mapping_parts: DataFrame,
              shards_per_part: int = FILES_PER_PART) -> DataFrame:
    """Index metadata: settings, mapping, primary term and allocation per shard.

    ``mapping_parts`` comes from ``build_mapping``; a backup without it gets an empty
    list of mappings."""
    settings = F.to_json(F.struct(
        F.col("total_shards").cast("string").alias("index.number_of_shards"),
        F.col("replicas").cast("string").alias("index.number_of_replicas"),
        F.lit(str(rules.TARGET_VERSION_ID)).alias("index.version.created"),
        _index_id().alias("index.uuid")))
    opening = F.concat(F.lit("{"), json_text(F.col("index_name")), F.lit(':{"settings":'), settings,
                       F.lit(',"mappings":['))
    path = F.concat(F.lit("indices/"), _index_id(), F.lit("/meta-"),
                    stable_id("metadata", F.col("backup_id")), F.lit(".dat"))
    shard_key = F.concat(F.lit('"'), F.col("shard_id").cast("string"), F.lit('":'))
    allocation = stable_id("allocation", F.col("backup_id"), F.col("shard_id"))

    def per_shard(section: int, value: Column) -> DataFrame:
        parts = numbered_parts(
            shards.select("backup_id", F.col("shard_id").alias("place"), F.lit("").alias("name"),
                          F.concat(shard_key, value).alias("body")),
            ["backup_id"], shards_per_part)
        return _document(parts, path, _section(section, F.col("chunk")), F.col("body"))

    return reduce(DataFrame.unionByName, [
        _document(conversions, path, _section(0), opening),
        _document(mapping_parts, path, _section(1, F.col("part")), F.col("body")),
        _document(conversions, path, _section(2), F.lit('],"primary_terms":{')),
        per_shard(3, F.lit("1")),
        _document(conversions, path, _section(4), F.lit('},"in_sync_allocations":{')),
        per_shard(5, F.concat(F.lit('["'), allocation, F.lit('"]'))),
        _document(conversions, path, _section(6), F.lit("}}}")),
    ])


# --- documents of a shard --------------------------------------------------------


def _shard_path(name: Column) -> Column:
    return F.concat(F.lit("indices/"), _index_id(), F.lit("/"), F.col("shard_id").cast("string"),
                    F.lit("/"), name)


def file_chunks(manifest: DataFrame, files_per_part: int = FILES_PER_PART) -> DataFrame:
    """The files of each shard as bounded pieces of JSON text: (backup_id, shard_id, chunk,
    entries, names). Both documents of a shard are made from these.

    A manifest without ``meta_hash`` gets it where the texts are made: a hash cannot be
    compressed, and what it is made of is moved anyway."""
    given = "meta_hash" in manifest.columns
    hashed = F.col("meta_hash") if given else meta_hash(*[
        F.col(c) for c in ("name", "length", "checksum", "written_by")])
    entry = F.to_json(F.struct(
        F.col("name").alias("name"), F.col("name").alias("physical_name"), "length", "written_by",
        "checksum", hashed.alias("meta_hash")))
    files = manifest.select(
        "backup_id", "shard_id", text_hash(F.col("name")).alias("place"), "name", "length", "written_by", "checksum",
        *["meta_hash"] * given)
    return list_parts(files, ["backup_id", "shard_id"], files_per_part,
                      {"entries": entry, "names": F.to_json(F.struct("name"))})


def shard_snapshot_doc(chunks: DataFrame, shards: DataFrame, now_ms: int) -> DataFrame:
    """Snapshot document of each shard: totals, then six attributes per file.

    ``chunks`` comes from ``file_chunks``; ``shards`` is the roll-up with (files, bytes)
    and optionally ``index_name``."""
    shards = shards.withColumn("index_name", _index_name(shards))
    totals = F.to_json(F.struct(
        _snapshot_name().alias("name"),
        F.lit(rules.TARGET_VERSION_ID).alias("index_version"),
        F.lit(now_ms).cast("bigint").alias("start_time"),
        F.lit(0).alias("time"),
        F.col("files").alias("number_of_files"),
        F.col("bytes").alias("total_size")))
    opening = F.concat(F.expr("left(body, length(body) - 1)"), F.lit(',"files":['))
    path = _shard_path(F.concat(F.lit("snap-"), _snapshot_id(), F.lit(".dat")))
    return reduce(DataFrame.unionByName, [
        _document(shards.withColumn("body", totals), path, _section(0), opening),
        _document(chunks, path, _section(1, F.col("chunk")), F.col("entries")),
        _document(shards, path, _section(2), F.lit("]}")),
    ])


def shard_index_doc(chunks: DataFrame, shards: DataFrame) -> DataFrame:
    """Index document of each shard: the files, then the file names per snapshot."""
    generation = stable_id("generation", F.col("backup_id"), F.col("shard_id"))
    path = _shard_path(F.concat(F.lit("index-"), generation))
    middle = F.concat(F.lit('],"snapshots":{"'), _snapshot_id(), F.lit('":{"files":['))

    def fragments(df: DataFrame, *parts: tuple[int, Column | int, Column]) -> DataFrame:
        """Several parts of the document from each row."""
        rows = F.explode(F.array(*[
            F.struct(_section(section, chunk), body.alias("body"))
            for section, chunk, body in parts]))
        return df.select("backup_id", path.alias("rel_path"), rows.alias("p")).select(
            "backup_id", "rel_path", "p.*")

    return fragments(
        shards, (0, 0, F.lit('{"files":[')), (2, 0, middle), (4, 0, F.lit("]}}}"))
    ).unionByName(fragments(
        chunks, (1, F.col("chunk"), F.col("entries")), (3, F.col("chunk"), F.col("names"))))
