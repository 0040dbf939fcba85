"""Jobs on real files. Each writes what Spark derives from the tables into a new folder
below the shared scratch folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import stored_checksum, utc_wall_clock
from ..operators import manifest
from ..operators.numbering import number_rows
from ..session import materialized, scratch_dir, shared_path
from ..sinks.copy import copy_files, file_crc
from ..sinks.repository import write_batches, write_repository
from ..sources import files
from ..sources.records import batch_records, batch_summary, load_records
from .catalog import query
from .convert import convert_backups


@query("batch_records", """
SELECT batch, count(*) AS records, min(i) + 1 AS first_record, max(i) + 1 AS last_record FROM (
  SELECT row_number() OVER (ORDER BY event_id) - 1 AS i,
    (row_number() OVER (ORDER BY event_id) - 1) // 500 AS batch FROM events) x GROUP BY 1""")
def _(t):
    return batch_summary(batch_records(t.events.select("event_id"), ["event_id"]))


@query("number_rows", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders""")
def _(t):
    return number_rows(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
                       "position").select("o_orderkey", "position")


def _document_files(t, label: str):
    """Every document as a file: a folder per source, text in one part, an index footer
    with the text's checksum in the next. Returns root and the files written."""
    root = shared_path(scratch_dir(t.spark, label))
    text = F.col("text").cast("binary")
    lead = F.concat(text, F.unhex(F.lit("C02893E800000000")))
    stored = F.unhex(F.lpad(F.hex(F.crc32(lead)), 16, "0"))
    path = F.concat(F.lit("snapshot."), F.col("source"), F.lit("/_"), F.col("doc_id").cast("string"),
                    F.lit(".fdt"))
    parts = t.documents.select(
        F.lit(root).alias("root"), path.alias("rel_path"),
        F.explode(F.array(
            F.struct(F.lit(0).cast("bigint").alias("part"), text.alias("body")),
            F.struct(F.lit(1).cast("bigint").alias("part"),
                     F.concat(F.unhex(F.lit("C02893E800000000")), stored).alias("body")),
        )).alias("p")).select("root", "rel_path", "p.*")
    return root, materialized(write_repository(parts), "written")


@query("write_repository", """
SELECT 'snapshot.' || source || '/_' || doc_id || '.fdt' AS rel_path, strlen(text) + 16 AS length, CAST(2 AS BIGINT) AS parts
FROM documents""")
def _(t):
    _, written = _document_files(t, "write")
    return written.select("rel_path", "length", "parts")


@query("file_inventory", """
SELECT 'b' AS backup_id, '' AS rel_dir, '' AS name, true AS is_dir, 0 AS length
UNION ALL SELECT DISTINCT 'b', '', 'snapshot.' || source, true, 0 FROM documents
UNION ALL SELECT 'b', 'snapshot.' || source, '_' || doc_id || '.fdt', false, strlen(text) + 16 FROM documents""")
def _(t):
    root, written = _document_files(t, "list")
    roots = written.select(F.lit("b").alias("backup_id"), "root").distinct()
    return files.scan_files(roots).select("backup_id", "rel_dir", "name", "is_dir", "length")


@query("copy_files", """
SELECT 'snapshot.' || source || '/_' || doc_id || '.fdt' AS rel_path, strlen(text) + 16 AS length, true AS ok
FROM documents""")
def _(t):
    root, written = _document_files(t, "source")
    target = shared_path(scratch_dir(t.spark, "target"))
    plan = written.select(
        F.concat_ws("/", "root", "rel_path").alias("path"),
        F.concat_ws("/", F.lit(target), "rel_path").alias("target"), "length")
    copied = copy_files(plan, range_bytes=1 << 16)
    return copied.select(F.substr("target", F.lit(len(target) + 2)).alias("rel_path"),
                         "length", "ok")


@query("verify_checksum", """
SELECT 'snapshot.' || source || '/_' || doc_id || '.fdt' AS rel_path, true AS intact FROM documents""")
def _(t):
    root, written = _document_files(t, "verify")
    paths = written.select("rel_path", F.concat_ws("/", "root", "rel_path").alias("path"), "length")
    footers = files.read_tails(paths).withColumn("checksum", stored_checksum(F.col("tail")))
    crcs = file_crc(paths, leave_out=8, range_bytes=1 << 16).select("path", "crc")
    return manifest.verify_checksum(footers.join(crcs, "path")).select("rel_path", "intact")


def _backup_trees(t, label: str):
    """A sharded backup per document source: four shards of document files with footers,
    a commit per shard, a schema and a state. Returns backups and segments."""
    root = shared_path(scratch_dir(t.spark, label))
    lead = F.unhex(F.lit("C02893E800000000"))
    text = F.col("text").cast("binary")
    stored = F.unhex(F.lpad(F.hex(F.crc32(F.concat(text, lead))), 16, "0"))
    shard = F.floor(F.col("doc_id") / 20) % 4
    folder = F.concat(F.col("source"), F.lit("/snapshot.shard"), (shard + 1).cast("string"))
    name = F.concat(F.lit("_"), F.col("doc_id").cast("string"), F.lit(".fdt"))
    data = t.documents.select(F.concat_ws("/", folder, name).alias("rel_path"),
                              F.concat(text, lead, stored).alias("body"))
    sources = t.documents.select("source").distinct()
    every = sources.select("source", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("shard"))
    head = F.concat(F.lit("commit").cast("binary"), lead)
    commits = every.select(
        F.concat("source", F.lit("/snapshot.shard"), (F.col("shard") + 1).cast("string"),
                 F.lit("/segments_3")).alias("rel_path"),
        F.concat(head, F.unhex(F.lpad(F.hex(F.crc32(head)), 16, "0"))).alias("body"))
    schema = F.concat(
        F.lit('<schema><fieldType name="body" class="solr.TextField"/><field name="text" type="body"/>'
              '<field name="lang" type="string"/><field name="_version_" type="plong"/><field name="'),
        F.col("source"), F.lit('" type="odd"/></schema>'))
    extra = sources.select(F.explode(F.array(
        F.struct(F.concat("source", F.lit("/zk_backup/configs/_default/managed-schema")).alias("rel_path"),
                 schema.cast("binary").alias("body")),
        F.struct(F.concat("source", F.lit("/zk_backup/collection_state.json")).alias("rel_path"),
                 F.lit('{"c":{"replicationFactor":"3"}}').cast("binary").alias("body")),
    )).alias("f")).select("f.*")
    parts = data.unionByName(commits).unionByName(extra).select(
        F.lit(root).alias("root"), "rel_path", F.lit(0).cast("bigint").alias("part"), "body")
    materialized(write_repository(parts), "written")
    backups = sources.select(
        F.col("source").alias("backup_id"), F.concat_ws("/", F.lit(root), "source").alias("input_dir"),
        F.concat_ws("/", F.lit(root + "-out"), "source").alias("output_dir"),
        F.concat(F.lit("idx_"), "source").alias("index_name"), F.lit(-1).alias("replicas"))
    segments = t.documents.select(
        F.col("source").alias("backup_id"), shard.alias("shard_id"),
        F.concat(F.lit("_"), F.col("doc_id").cast("string")).alias("segment"),
        F.col("n_chars").alias("max_doc"), F.lit("9.8.0").alias("lucene_version"),
        F.array(name).alias("files"))
    empty = every.select(
        F.col("source").alias("backup_id"), F.col("shard").cast("bigint").alias("shard_id"),
        F.lit(None).cast("string").alias("segment"), F.lit(0).cast("bigint").alias("max_doc"),
        F.lit("9.8.0").alias("lucene_version"), F.array().cast("array<string>").alias("files"))
    return backups, segments.unionByName(empty)


@query("convert_backups", """
SELECT source AS backup_id, 'idx_' || source AS index_name, CAST(4 AS BIGINT) AS total_shards,
  count(*) + 4 AS total_files, CAST(sum(n_chars) AS BIGINT) AS total_docs,
  CAST(sum(strlen(text) + 16) + 4 * 22 AS BIGINT) AS total_bytes, 2 AS replicas,
  CAST(13 AS BIGINT) AS metadata_files, true AS complete
FROM documents GROUP BY source""")
def _(t):
    backups, segments = _backup_trees(t, "convert")
    return convert_backups(backups, segments, 1717243200000, range_bytes=1 << 16).results.select(
        "backup_id", "index_name", "total_shards", "total_files", "total_docs", "total_bytes",
        "replicas", "metadata_files", "complete")


@query("conversion_issues", """
WITH empty AS (
  SELECT source, shard FROM (SELECT DISTINCT source, unnest([0, 1, 2, 3]) AS shard FROM documents) e
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = e.source AND d.doc_id // 20 % 4 = e.shard))
SELECT DISTINCT source AS backup_id, 'WARN' AS severity, 'TYPE_UNKNOWN' AS code, source AS subject,
  'odd' AS detail FROM documents
UNION ALL SELECT source, 'WARN', unnest(['NO_SEGMENTS', 'NO_DOCUMENTS']), 'shard ' || (shard + 1), '' FROM empty
""")
def _(t):
    backups, segments = _backup_trees(t, "issues")
    return convert_backups(backups, segments, 1717243200000, range_bytes=1 << 16).issues


#: Orders as records, and the mapped type of each field.
ORDER_TYPES = {"id": "long", "status": "keyword", "placed": "date", "cents": "long", "priority": "text"}


def _order_batches(t, label: str):
    """Orders as JSON batches of 500 below a new folder; the folder."""
    root = shared_path(scratch_dir(t.spark, label))
    orders = t.orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("placed"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.col("o_orderpriority").alias("priority"))
    materialized(write_batches(batch_records(orders, ["id"]), root), "written")
    return root


@query("write_batches", """
SELECT 'batch_' || b || '.json' AS name, md5('[' || string_agg('{"id":' || o_orderkey || ',"status":"' || o_orderstatus
    || '","placed":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","cents":' || CAST(round(o_totalprice * 100) AS BIGINT)
    || ',"priority":"' || o_orderpriority || '"}', ',' ORDER BY o_orderkey) || ']') AS body_md5
FROM (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS b FROM orders) x GROUP BY b""")
def _(t):
    root = _order_batches(t, "batches")
    files_read = t.spark.read.text(root, wholetext=True)
    return files_read.select(F.col("_metadata.file_name").alias("name"), F.md5("value").alias("body_md5"))


@query("load_records", """
SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS status, CAST(o_orderdate AS TIMESTAMP) AS placed,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority AS priority FROM orders""")
def _(t):
    loaded = load_records(t.spark, _order_batches(t, "load"), ORDER_TYPES)
    return loaded.withColumn("placed", utc_wall_clock(F.col("placed")))
