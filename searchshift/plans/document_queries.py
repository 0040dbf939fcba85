"""Manifests, roll-ups, identifiers and metadata documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions.values import format_bytes, stable_id, version_id
from ..operators import compat, detect, documents, manifest, mapping
from ..session import materialized
from .catalog import query
from .detection_queries import REFERENCED, with_files
from .validation_queries import bytes_sql

NOW = 1717243200000
FILES_PER_PART = 20
SHARDS_PER_PART = 3


def id_sql(kind: str, *columns: str) -> str:
    key = " || '/' || ".join([f"'{kind}'", *columns])
    return (f"replace(replace(replace(base64(unhex(substring(sha256({key}), 1, 32))), '+', '-'), "
            "'/', '_'), '=', '')")


SNAPSHOT = id_sql("snapshot", "backup_id")
INDEX = id_sql("index", "backup_id")
METADATA = id_sql("metadata", "backup_id")
GENERATION = id_sql("generation", "backup_id", "shard_id")
ALLOCATION = id_sql("allocation", "backup_id", "shard_id")
HASHED = "sha256(name || length || checksum || written_by)"
SECTION = documents.SECTION

ROLLUP = """
file_totals AS (SELECT backup_id, shard_id, count(*) AS files, sum(length) AS bytes FROM fx_manifest GROUP BY 1, 2),
commit_totals AS (SELECT backup_id, shard_id, sum(max_doc) AS max_docs, count(segment) AS segments,
  max(lucene_version) AS lucene_version FROM fx_segments GROUP BY 1, 2),
rollup AS (
  SELECT backup_id, shard_id, coalesce(max_docs, 0) AS max_docs, coalesce(segments, 0) AS segments,
    coalesce(files, 0) AS files, coalesce(bytes, 0) AS bytes, lucene_version
  FROM file_totals FULL JOIN commit_totals USING (backup_id, shard_id)),
totals AS (
  SELECT backup_id, count(*) AS total_shards, CAST(sum(files) AS BIGINT) AS total_files,
    CAST(sum(max_docs) AS BIGINT) AS total_docs, CAST(sum(bytes) AS BIGINT) AS total_bytes,
    5 + 2 * count(*) AS metadata_files FROM rollup GROUP BY 1),
conversions AS (
  SELECT backup_id, 'idx_' || backup_id AS index_name, count(*) AS total_shards,
    CAST(substring(backup_id, 2) AS BIGINT) % 3 AS replicas FROM rollup GROUP BY 1)"""


def _manifest(t):
    return manifest.with_meta_hash(t.fx_manifest)


def _chunks(t):
    return documents.file_chunks(t.fx_manifest, FILES_PER_PART)


def _rollup(t):
    return manifest.shard_rollup(t.fx_manifest, t.fx_segments)


def _written_rollup(t):
    """The roll-up, one small row per shard, written down for several readers."""
    return materialized(_rollup(t), "rollup")


def _conversions(rollup):
    """Conversions as the planning steps would hand them over."""
    return rollup.groupBy("backup_id").agg(F.count("*").alias("total_shards")).withColumn(
        "index_name", F.concat(F.lit("idx_"), F.col("backup_id"))).withColumn(
        "replicas", F.substr("backup_id", F.lit(2)).cast("bigint") % 3)


@query("meta_hash", f"""
SELECT backup_id, shard_id, name, lower({HASHED}) AS meta_hash FROM fx_manifest""")
def _(t):
    return _manifest(t).select("backup_id", "shard_id", "name",
                               F.lower(F.hex("meta_hash")).alias("meta_hash"))


def _tails(t):
    """Files as their last bytes: documents with a footer made from their id."""
    stored = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    wide = F.when(F.col("doc_id") % 17 == 0, F.lit("00000001")).otherwise(F.lit("00000000"))
    lead = F.when(F.col("doc_id") % 19 == 0, F.lit("C02893E900000000")).otherwise(
        F.lit(rules.FOOTER_LEAD_HEX))
    content = F.concat(F.col("text").cast("binary"), F.unhex(F.concat(
        lead, wide, F.lpad(F.hex(stored), 8, "0"))))
    short = F.col("doc_id") % 23 == 0
    return t.documents.select(
        F.col("source").alias("backup_id"), F.lit(0).cast("bigint").alias("shard_id"),
        F.concat(F.lit("_"), F.col("doc_id").cast("string"), F.lit(".fdt")).alias("name"),
        F.when(short, F.lit("short").cast("binary")).otherwise(
            F.substring(content, -16, 16)).alias("tail"))


_CHECKSUM = """CASE WHEN doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 THEN NULL
  ELSE lower(to_base(CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT), 36)) END"""


@query("footer_checksum", f"""
SELECT source AS backup_id, '_' || doc_id || '.fdt' AS name, {_CHECKSUM} AS checksum FROM documents""")
def _(t):
    return manifest.footer_checksum(_tails(t)).select("backup_id", "name", "checksum")


@query("footer_issues", f"""
SELECT source AS backup_id, 'ERROR' AS severity, 'FOOTER_INVALID' AS code, 'shard 1' AS subject,
  '_' || doc_id || '.fdt' AS detail FROM documents WHERE {_CHECKSUM} IS NULL""")
def _(t):
    return manifest.footer_issues(manifest.footer_checksum(_tails(t)))


@query("shard_rollup", f"""
WITH {ROLLUP} SELECT backup_id, shard_id, CAST(max_docs AS BIGINT) AS max_docs, segments, files,
  CAST(bytes AS BIGINT) AS bytes, lucene_version FROM rollup""")
def _(t):
    return _rollup(t)


def _skipped(t):
    segments = with_files(t.fx_segments.filter(F.col("segment").isNotNull()))
    return detect.missing_files(segments, t.fx_files)


@query("conversion_rollup", f"""
WITH {ROLLUP}, {REFERENCED},
holes AS (SELECT DISTINCT backup_id FROM referenced r WHERE NOT EXISTS (SELECT 1 FROM fx_files f
  WHERE r.backup_id = f.backup_id AND r.shard_id = f.shard_id AND r.name = f.name))
SELECT *, {bytes_sql('total_bytes')} AS size, backup_id NOT IN (SELECT backup_id FROM holes) AS complete FROM totals""")
def _(t):
    return manifest.conversion_rollup(_rollup(t), _skipped(t))


@query("shard_breakdown", f"""
WITH {ROLLUP} SELECT backup_id, shard_id, CAST(max_docs AS BIGINT) AS max_docs, segments, files,
  CAST(bytes AS BIGINT) AS bytes, lucene_version, {bytes_sql('CAST(bytes AS BIGINT)')} AS size
FROM rollup WHERE backup_id IN (SELECT backup_id FROM totals WHERE total_shards > 1)""")
def _(t):
    shards = _written_rollup(t)
    return manifest.shard_breakdown(shards, manifest.conversion_rollup(shards))


@query("format_bytes", f"""
SELECT name, n, {bytes_sql('n')} AS size FROM (
  SELECT name, CAST(length * CASE checksum[1] WHEN 'a' THEN 1 WHEN 'b' THEN 1000 WHEN 'c' THEN 100000
    WHEN '1' THEN 64 ELSE 0 END // CASE checksum[2] WHEN 'a' THEN 1024 ELSE 1 END AS BIGINT) AS n FROM fx_manifest) x""")
def _(t):
    first, second = F.substring("checksum", 1, 1), F.substring("checksum", 2, 1)
    factor = (F.when(first == "a", 1).when(first == "b", 1000).when(first == "c", 100000)
              .when(first == "1", 64).otherwise(0))
    n = F.floor(F.col("length") * factor / F.when(second == "a", 1024).otherwise(1))
    return t.fx_manifest.select("name", n.alias("n"), format_bytes(n).alias("size"))


@query("metadata_file_count", """
SELECT backup_id, 5 + 2 * count(DISTINCT shard_id) AS metadata_files FROM fx_manifest GROUP BY 1""")
def _(t):
    return manifest.metadata_file_count(t.fx_manifest)


@query("commit_user_data", f"""
WITH {ROLLUP}, last AS (SELECT backup_id, shard_id, CAST(greatest(0, max_docs - 1) AS VARCHAR) AS v FROM rollup)
SELECT backup_id, shard_id, unnest(['history_uuid', 'local_checkpoint', 'max_seq_no', 'min_retained_seqno',
    'max_unsafe_auto_id_timestamp', 'translog_uuid', 'translog_gen', 'min_translog_gen']) AS key,
  unnest([{id_sql('history', 'backup_id', 'shard_id')}, v, v, '0', '-1',
    {id_sql('log', 'backup_id', 'shard_id')}, '1', '1']) AS value FROM last""")
def _(t):
    return manifest.commit_user_data(_rollup(t)).select(
        "backup_id", "shard_id", F.explode("user_data").alias("key", "value"))


@query("stable_ids", f"""
SELECT DISTINCT backup_id, shard_id, {SNAPSHOT} AS snapshot_id, {INDEX} AS index_id, {METADATA} AS metadata_id,
  {GENERATION} AS generation_id, {ALLOCATION} AS allocation_id,
  {id_sql('history', 'backup_id', 'shard_id')} AS history_id, {id_sql('log', 'backup_id', 'shard_id')} AS log_id
FROM fx_manifest""")
def _(t):
    shards = t.fx_manifest.select("backup_id", "shard_id").distinct()
    return documents.with_shard_ids(documents.with_conversion_ids(shards))


@query("snapshot_doc", f"""
WITH {ROLLUP} SELECT backup_id, 'snap-' || {SNAPSHOT} || '.dat' AS rel_path, 0::BIGINT AS part,
  '{{"snapshot":{{"name":"' || index_name || '-snapshot","uuid":"' || {SNAPSHOT} || '","version_id":2110199,'
  || '"remote_store_index_shallow_copy":false,"indices":["' || index_name || '"],"data_streams":[],'
  || '"state":"SUCCESS","include_global_state":false,"metadata":null,"start_time":{NOW},"end_time":{NOW},'
  || '"total_shards":' || total_shards || ',"successful_shards":' || total_shards || ',"failures":[]}}}}' AS body
FROM conversions""")
def _(t):
    return documents.snapshot_doc(_conversions(_rollup(t)), NOW)


@query("global_doc", f"""
WITH {ROLLUP} SELECT backup_id, 'meta-' || {SNAPSHOT} || '.dat' AS rel_path, 0::BIGINT AS part,
  '{{"meta-data":{{"version":1,"cluster_uuid":"' || {SNAPSHOT} || '"}}}}' AS body FROM conversions""")
def _(t):
    return documents.global_doc(_conversions(_rollup(t)))


@query("repo_index_doc", f"""
WITH {ROLLUP}, chunks AS (
  SELECT backup_id, shard_id // {SHARDS_PER_PART} AS c,
    string_agg('"' || {GENERATION} || '"', ',' ORDER BY shard_id) AS body FROM rollup GROUP BY 1, 2)
SELECT backup_id, 'index-0' AS rel_path, 0 AS part, '{{"snapshots":[{{"name":"' || index_name || '-snapshot","uuid":"'
  || {SNAPSHOT} || '","state":1,"index_metadata_lookup":{{"' || {INDEX} || '":"' || {INDEX} || '-_na_-1-1-1"}},'
  || '"version":"2.11.1"}}],"indices":{{"' || index_name || '":{{"id":"' || {INDEX} || '","snapshots":["' || {SNAPSHOT}
  || '"],"shard_generations":[' AS body FROM conversions
UNION ALL SELECT backup_id, 'index-0', {SECTION} + c, CASE WHEN c > 0 THEN ',' ELSE '' END || body FROM chunks
UNION ALL SELECT backup_id, 'index-0', {2 * SECTION}, ']}}}},"index_metadata_identifiers":{{"' || {INDEX}
  || '-_na_-1-1-1":"' || {METADATA} || '"}}}}' FROM conversions""")
def _(t):
    rollup = _written_rollup(t)
    return documents.repo_index_doc(_conversions(rollup), rollup, SHARDS_PER_PART)


@query("index_doc", f"""
WITH {ROLLUP}, per_shard AS (
  SELECT backup_id, shard_id // {SHARDS_PER_PART} AS c,
    string_agg('"' || shard_id || '":1', ',' ORDER BY shard_id) AS terms,
    string_agg('"' || shard_id || '":["' || {ALLOCATION} || '"]', ',' ORDER BY shard_id) AS ids
  FROM rollup GROUP BY 1, 2),
placed AS (SELECT *, CAST('0x' || substring(md5(field), 1, 8) AS BIGINT) AS h,
  CAST(ceil(count(*) OVER (PARTITION BY backup_id) / 1000) AS BIGINT) AS n FROM fx_supplier_fields),
fields AS (SELECT backup_id, n, (h * n) >> 32 AS c, string_agg(CAST(to_json(field) AS VARCHAR) || ':{{"type":"'
    || target_type || '"}}', ',' ORDER BY h, field) AS body FROM placed GROUP BY 1, 2, 3),
parts AS (
  SELECT backup_id, 0 AS part, '{{"' || index_name || '":{{"settings":{{"index.number_of_shards":"' || total_shards
    || '","index.number_of_replicas":"' || replicas || '","index.version.created":"2110199","index.uuid":"'
    || {INDEX} || '"}},"mappings":[' AS body FROM conversions
  UNION ALL SELECT backup_id, {SECTION} + c,
    CASE WHEN c = min(c) OVER (PARTITION BY backup_id) THEN '{{"_doc":{{"properties":{{' ELSE ',' END || body
    || CASE WHEN c = max(c) OVER (PARTITION BY backup_id) THEN '}}}}}}' ELSE '' END FROM fields
  UNION ALL SELECT backup_id, {2 * SECTION}, '],"primary_terms":{{' FROM conversions
  UNION ALL SELECT backup_id, {3 * SECTION} + c, CASE WHEN c > 0 THEN ',' ELSE '' END || terms FROM per_shard
  UNION ALL SELECT backup_id, {4 * SECTION}, '}},"in_sync_allocations":{{' FROM conversions
  UNION ALL SELECT backup_id, {5 * SECTION} + c, CASE WHEN c > 0 THEN ',' ELSE '' END || ids FROM per_shard
  UNION ALL SELECT backup_id, {6 * SECTION}, '}}}}}}' FROM conversions)
SELECT backup_id, 'indices/' || {INDEX} || '/meta-' || {METADATA} || '.dat' AS rel_path, part, body FROM parts""")
def _(t):
    parts = mapping.build_mapping(t.fx_supplier_fields)
    rollup = _written_rollup(t)
    return documents.index_doc(_conversions(rollup), rollup, parts, SHARDS_PER_PART)


_ENTRY = f"""'{{"name":"' || name || '","physical_name":"' || name || '","length":' || length
  || ',"written_by":"' || written_by || '","checksum":"' || checksum || '","meta_hash":"'
  || base64(unhex({HASHED})) || '"}}'"""

FILE_CHUNKS = f"""
placed AS (
  SELECT *, CAST('0x' || substring(md5(name), 1, 8) AS BIGINT) AS h,
    CAST(ceil(count(*) OVER (PARTITION BY backup_id, shard_id) / {FILES_PER_PART}) AS BIGINT) AS n,
    {_ENTRY} AS entry, '{{"name":"' || name || '"}}' AS short FROM fx_manifest),
chunked AS (
  SELECT backup_id, shard_id, (h * n) >> 32 AS c, string_agg(entry, ',' ORDER BY h, name, entry) AS entries,
    string_agg(short, ',' ORDER BY h, name) AS names FROM placed GROUP BY 1, 2, 3),
chunks AS (SELECT *, CASE WHEN c > min(c) OVER (PARTITION BY backup_id, shard_id) THEN ',' ELSE '' END AS lead
  FROM chunked)"""


@query("shard_snapshot_doc", f"""
WITH {ROLLUP}, {FILE_CHUNKS},
parts AS (
  SELECT backup_id, shard_id, 0 AS part, '{{"name":"' || backup_id || '-snapshot","index_version":2110199,"start_time":{NOW},'
    || '"time":0,"number_of_files":' || files || ',"total_size":' || bytes || ',"files":[' AS body FROM rollup
  UNION ALL SELECT backup_id, shard_id, {SECTION} + c, lead || entries FROM chunks
  UNION ALL SELECT backup_id, shard_id, {2 * SECTION}, ']}}' FROM rollup)
SELECT backup_id, 'indices/' || {INDEX} || '/' || shard_id || '/snap-' || {SNAPSHOT} || '.dat' AS rel_path, part, body
FROM parts""")
def _(t):
    return documents.shard_snapshot_doc(_chunks(t), _written_rollup(t), NOW)


@query("shard_index_doc", f"""
WITH {ROLLUP}, {FILE_CHUNKS},
parts AS (
  SELECT backup_id, shard_id, 0 AS part, '{{"files":[' AS body FROM rollup
  UNION ALL SELECT backup_id, shard_id, {SECTION} + c, lead || entries FROM chunks
  UNION ALL SELECT backup_id, shard_id, {2 * SECTION}, '],"snapshots":{{"' || {SNAPSHOT} || '":{{"files":[' FROM rollup
  UNION ALL SELECT backup_id, shard_id, {3 * SECTION} + c, lead || names FROM chunks
  UNION ALL SELECT backup_id, shard_id, {4 * SECTION}, ']}}}}}}' FROM rollup)
SELECT backup_id, 'indices/' || {INDEX} || '/' || shard_id || '/index-' || {GENERATION} AS rel_path, part, body
FROM parts""")
def _(t):
    return documents.shard_index_doc(_chunks(t), _written_rollup(t))


# --- versions --------------------------------------------------------------------


_TARGETS = ", ".join(f"('{v}', '{lib}', {lib.split('.')[0]})" for v, lib in rules.TARGETS)
COMPAT = f"""
versions AS (SELECT lucene_version, CAST(split_part(lucene_version, '.', 1) AS INTEGER) AS major,
  count(*) AS indexes FROM fx_segments GROUP BY 1, 2),
verdicts AS (
  SELECT lucene_version, indexes, target_version, target_library, target_major,
    target_major - major BETWEEN 0 AND 1 AS target_reads, major IN (8, 9) AS converter_reads
  FROM versions, (VALUES {_TARGETS}) t(target_version, target_library, target_major)),
matrix AS (
  SELECT *, CASE WHEN target_reads AND converter_reads THEN 'YES' WHEN target_reads THEN 'MAYBE' ELSE 'NO' END AS compatible
  FROM verdicts),
outcomes AS (
  SELECT m.lucene_version, m.target_version, target_library, indexes, compatible,
    CASE WHEN r.outcome IS NULL THEN 'NO' ELSE 'YES' END AS tested,
    coalesce(r.outcome, CASE WHEN compatible = 'NO' THEN 'N/A' ELSE '-' END) AS status
  FROM matrix m LEFT JOIN (VALUES ('9.8.0', '2.11.1', 'PASS'), ('8.11.4', '2.11.1', 'PASS'),
    ('7.7.3', '2.11.1', 'FAIL')) r(lucene_version, target_version, outcome)
    ON r.lucene_version = m.lucene_version AND r.target_version = m.target_version)"""


@query("compatible_versions", f"WITH {COMPAT} SELECT * FROM matrix")
def _(t):
    return compat.compatible_versions(t.fx_segments)


@query("matrix_status", f"WITH {COMPAT} SELECT * FROM outcomes")
def _(t):
    return compat.matrix_status(compat.compatible_versions(t.fx_segments))


@query("matrix_counts", f"""
WITH {COMPAT} SELECT status, count(*) AS pairs, CAST(sum(indexes) AS BIGINT) AS indexes FROM outcomes GROUP BY 1""")
def _(t):
    return compat.matrix_counts(compat.matrix_status(compat.compatible_versions(t.fx_segments)))


@query("matrix_pivot", f"""
WITH {COMPAT} SELECT lucene_version, max(status) FILTER (WHERE target_version = '1.x') AS "1.x",
  max(status) FILTER (WHERE target_version = '2.0') AS "2.0",
  max(status) FILTER (WHERE target_version = '2.11.1') AS "2.11.1",
  max(status) FILTER (WHERE target_version = '2.19.1') AS "2.19.1" FROM outcomes GROUP BY 1""")
def _(t):
    return compat.matrix_pivot(compat.matrix_status(compat.compatible_versions(t.fx_segments)))


@query("version_id", """
SELECT o_orderkey, (o_orderkey % 4) * 1000000 + (o_custkey % 20) * 10000 + (o_orderkey % 7) * 100 + 99 AS version_id
FROM orders""")
def _(t):
    version = F.concat_ws(".", *[c.cast("string") for c in (
        F.col("o_orderkey") % 4, F.col("o_custkey") % 20, F.col("o_orderkey") % 7)])
    return t.orders.select("o_orderkey", version_id(version).cast("bigint").alias("version_id"))
