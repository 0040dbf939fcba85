"""Detection: which backups can be converted, and what is wrong with the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import detect, validate
from ..operators.issues import union_issues
from ..session import materialized
from ..sources.state import collection_state
from .catalog import query

SHARDS = r"""
shard_list AS (
  SELECT backup_id, name AS dir, TRY_CAST(regexp_extract(name, '^snapshot\.shard([0-9]+)$', 1) AS INTEGER)::BIGINT AS n
  FROM fx_tree WHERE is_dir AND rel_dir = '' AND regexp_full_match(name, 'snapshot\.shard[0-9]+')),
ordered AS (
  SELECT backup_id, n, row_number() OVER (PARTITION BY backup_id ORDER BY n) AS i
  FROM shard_list WHERE n IS NOT NULL),
gaps AS (
  SELECT backup_id, min(i) AS expected, arg_min(n, i) AS actual FROM ordered WHERE n <> i GROUP BY backup_id),
with_commit AS (
  SELECT DISTINCT backup_id, rel_dir FROM fx_tree WHERE starts_with(name, 'segments_')),
bare AS (
  SELECT s.* FROM shard_list s WHERE NOT EXISTS (
    SELECT 1 FROM with_commit c WHERE c.backup_id = s.backup_id AND c.rel_dir = s.dir))"""

CLASSIFY = SHARDS + """,
incremental AS (
  SELECT DISTINCT backup_id FROM fx_tree WHERE name = 'backup_0.properties'
    AND (rel_dir = '' OR position('/' IN rel_dir) = 0)),
single AS (
  SELECT backup_id, CASE WHEN bool_or(rel_dir = '') THEN '' ELSE 'index' END AS index_dir
  FROM with_commit WHERE rel_dir IN ('', 'index') GROUP BY backup_id),
verdict AS (
  SELECT r.backup_id, k.shards, CASE
    WHEN NOT r.is_dir THEN 'NOT_A_DIRECTORY'
    WHEN r.backup_id IN (SELECT backup_id FROM incremental) THEN 'INCREMENTAL_BACKUP'
    WHEN k.overflow THEN 'SHARD_NUMBER_RANGE'
    WHEN g.backup_id IS NOT NULL THEN 'SHARD_GAP'
    WHEN b.bare > 0 THEN 'SHARD_WITHOUT_COMMIT'
    WHEN k.shards IS NULL AND s.backup_id IS NULL THEN 'UNKNOWN_FORMAT' END AS issue_code,
    g.expected, g.actual, b.bare
  FROM (SELECT backup_id, is_dir FROM fx_tree WHERE rel_dir = '' AND name = '') r
  LEFT JOIN (SELECT backup_id, count(*) AS shards, bool_or(n IS NULL) AS overflow
             FROM shard_list GROUP BY backup_id) k USING (backup_id)
  LEFT JOIN gaps g USING (backup_id)
  LEFT JOIN (SELECT backup_id, count(*) AS bare FROM bare GROUP BY backup_id) b USING (backup_id)
  LEFT JOIN single s USING (backup_id)),
formats AS (
  SELECT backup_id, issue_code,
    CASE WHEN issue_code IS NULL THEN CASE WHEN shards > 0 THEN 'SOLRCLOUD_FULL' ELSE 'STANDALONE' END END AS format,
    CASE issue_code WHEN 'SHARD_GAP' THEN 'expected ' || expected || ', found ' || actual
      WHEN 'SHARD_WITHOUT_COMMIT' THEN CAST(bare AS VARCHAR) END AS detail,
    CASE WHEN issue_code IS NULL THEN coalesce(shards, 1) END AS shard_count
  FROM verdict),
schemas AS (
  SELECT backup_id, arg_min(path, rank) AS schema_path FROM (
    SELECT backup_id, rel_dir || '/' || name AS path FROM fx_tree) t
  JOIN (VALUES ('zk_backup/configs/_default/managed-schema.xml', 1),
               ('zk_backup/configs/_default/managed-schema', 2),
               ('zk_backup_0/configs/_default/managed-schema.xml', 3),
               ('zk_backup_0/configs/_default/managed-schema', 4),
               ('conf/managed-schema.xml', 5), ('conf/managed-schema', 6)) c(path, rank) USING (path)
  GROUP BY backup_id),
state_values AS (
  SELECT backup_id, dir_rank, CASE WHEN json_valid(content) AND content <> '' THEN
    json_extract_string(content, '$.' || json_keys(content)[1] || '.replicationFactor') END AS v
  FROM fx_states),
factors AS (
  SELECT backup_id, coalesce(arg_min(CASE WHEN regexp_full_match(v, '-?[0-9]+') THEN CAST(v AS INTEGER)
      ELSE -1 END, dir_rank) FILTER (WHERE v IS NOT NULL), -1) AS replication_factor
  FROM state_values GROUP BY backup_id),
plan AS (
  SELECT f.backup_id, f.format, f.shard_count, p.schema_path,
    CASE WHEN f.format = 'STANDALONE' THEN -1 ELSE coalesce(r.replication_factor, -1) END AS replication_factor
  FROM formats f LEFT JOIN schemas p USING (backup_id) LEFT JOIN factors r USING (backup_id)
  WHERE f.format IS NOT NULL),
planned AS (
  SELECT s.backup_id, s.n - 1 AS shard_id, s.dir FROM shard_list s
  JOIN formats f USING (backup_id) WHERE f.format = 'SOLRCLOUD_FULL'
  UNION ALL SELECT s.backup_id, 0, s.index_dir FROM single s
  JOIN formats f USING (backup_id) WHERE f.format = 'STANDALONE')"""


@query("incremental_backups", """
SELECT backup_id, bool_or(rel_dir = '') AS in_root, count(*) AS markers FROM fx_tree
WHERE name = 'backup_0.properties' AND (rel_dir = '' OR position('/' IN rel_dir) = 0)
GROUP BY backup_id""")
def _(t):
    return detect.incremental_backups(t.fx_tree)


@query("backup_complete", """
SELECT DISTINCT backup_id FROM fx_tree WHERE rel_dir = '' AND name = 'backup.properties'""")
def _(t):
    return detect.completed_backups(t.fx_tree)


@query("shard_dirs", f"""
WITH {SHARDS} SELECT backup_id, dir, n AS shard_number, n - 1 AS shard_id FROM shard_list""")
def _(t):
    return detect.shard_dirs(t.fx_tree)


@query("shard_gaps", f"WITH {SHARDS} SELECT backup_id, expected, actual FROM gaps")
def _(t):
    return detect.shard_gaps(detect.shard_dirs(t.fx_tree))


@query("shards_without_commit", f"""
WITH {SHARDS} SELECT backup_id, dir, n AS shard_number FROM bare""")
def _(t):
    tree = t.fx_tree
    return detect.shards_without_commit(detect.shard_dirs(tree), tree).select(
        "backup_id", "dir", "shard_number")


@query("unmatched_shard_dirs", r"""
SELECT backup_id, 'WARN' AS severity, 'UNMATCHED_SHARD_DIR' AS code, name AS subject, 'ignored' AS detail
FROM fx_tree WHERE is_dir AND rel_dir = '' AND starts_with(name, 'snapshot.shard')
  AND NOT regexp_full_match(name, 'snapshot\.shard[0-9]+')""")
def _(t):
    return detect.unmatched_shard_dirs(t.fx_tree)


@query("standalone_index", f"WITH {CLASSIFY} SELECT backup_id, index_dir FROM single")
def _(t):
    return detect.standalone_index(t.fx_tree)


@query("classify_format", f"""
WITH {CLASSIFY} SELECT backup_id, format, issue_code, detail, shard_count FROM formats""")
def _(t):
    return detect.classify_format(t.fx_tree)


@query("resolve_schema_path", f"WITH {CLASSIFY} SELECT backup_id, schema_path FROM schemas")
def _(t):
    return detect.resolve_schema_path(t.fx_tree)


@query("collection_state", f"WITH {CLASSIFY} SELECT backup_id, replication_factor FROM factors")
def _(t):
    return collection_state(t.fx_states)


@query("resolve_replicas", f"""
WITH {CLASSIFY} SELECT backup_id, replication_factor,
  CASE WHEN explicit >= 0 THEN CAST(explicit AS INTEGER) WHEN replication_factor > 0 THEN replication_factor - 1 ELSE 0 END AS replicas,
  CASE WHEN explicit >= 0 THEN 'explicit' WHEN replication_factor > 0 THEN 'replication_factor'
    ELSE 'default' END AS replica_source
FROM (SELECT backup_id, replication_factor, CASE WHEN CAST(substring(backup_id, 2) AS BIGINT) % 4 = 0
        THEN CAST(substring(backup_id, 2) AS BIGINT) % 3 ELSE -1 END AS explicit FROM factors) x""")
def _(t):
    number = F.substr("backup_id", F.lit(2)).cast("bigint")
    asked = collection_state(t.fx_states).withColumn("format", F.lit("SOLRCLOUD_FULL")).withColumn(
        "asked", F.when(number % 4 == 0, (number % 3).cast("int")).otherwise(F.lit(-1)))
    return detect.resolve_replicas(asked, "asked").select(
        "backup_id", "replication_factor", "replicas", "replica_source")


@query("conversion_plan", f"""
WITH {CLASSIFY} SELECT backup_id, format, shard_count, schema_path, replication_factor,
  CASE WHEN replication_factor > 0 THEN replication_factor - 1 ELSE 0 END AS replicas,
  CASE WHEN replication_factor > 0 THEN 'replication_factor' ELSE 'default' END AS replica_source FROM plan""")
def _(t):
    # two operators read the tree, each its own few entries of it: the data files are not written down
    tree = t.fx_tree
    return detect.conversion_plan(detect.classify_format(tree), detect.resolve_schema_path(tree),
                                  collection_state(t.fx_states))


@query("plan_shards", f"WITH {CLASSIFY} SELECT backup_id, shard_id, dir FROM planned")
def _(t):
    tree = t.fx_tree
    formats = materialized(detect.classify_format(tree), "formats")
    return detect.plan_shards(formats, detect.shard_dirs(tree), detect.standalone_index(tree))


@query("latest_commit", """
WITH RECURSIVE digits AS (
  SELECT backup_id, rel_dir AS dir, name, substring(name, 10) AS suffix FROM fx_tree
  WHERE NOT is_dir AND regexp_full_match(name, 'segments_[0-9a-z]+')),
numbers AS (
  SELECT *, CASE length(suffix)
    WHEN 1 THEN position(suffix IN '0123456789abcdefghijklmnopqrstuvwxyz') - 1
    ELSE (position(substring(suffix, 1, 1) IN '0123456789abcdefghijklmnopqrstuvwxyz') - 1) * 36
      + position(substring(suffix, 2, 1) IN '0123456789abcdefghijklmnopqrstuvwxyz') - 1 END AS g
  FROM digits)
SELECT backup_id, dir, max(g) AS generation, arg_max(name, g) AS commit_file FROM numbers
GROUP BY backup_id, dir""".replace("WITH RECURSIVE", "WITH"))
def _(t):
    return detect.latest_commit(t.fx_tree)


def with_files(segments):
    """Segments with the names of their files."""
    return segments.withColumn("files", F.array(*[
        F.concat("segment", F.lit(ext)) for ext in (".fdt", ".fdx", ".si")]))


REFERENCED = """
referenced AS (
  SELECT DISTINCT backup_id, shard_id, segment || ext AS name
  FROM fx_segments CROSS JOIN (VALUES ('.fdt'), ('.fdx'), ('.si')) e(ext) WHERE segment IS NOT NULL)"""


@query("live_files", f"""
WITH {REFERENCED} SELECT f.backup_id, f.shard_id, f.name, f.length FROM fx_files f WHERE EXISTS (
  SELECT 1 FROM referenced r WHERE r.backup_id = f.backup_id AND r.shard_id = f.shard_id AND r.name = f.name)""")
def _(t):
    segments = with_files(t.fx_segments.filter(F.col("segment").isNotNull()))
    return detect.live_files(segments, t.fx_files)


@query("missing_files", f"""
WITH {REFERENCED} SELECT backup_id, 'WARN' AS severity, 'FILE_MISSING' AS code,
  'shard ' || (shard_id + 1) AS subject, name AS detail FROM referenced r WHERE NOT EXISTS (
  SELECT 1 FROM fx_files f WHERE r.backup_id = f.backup_id AND r.shard_id = f.shard_id AND r.name = f.name)""")
def _(t):
    segments = with_files(t.fx_segments.filter(F.col("segment").isNotNull()))
    return detect.missing_files(segments, t.fx_files)


@query("detection_issues", f"""
WITH {CLASSIFY} SELECT backup_id, 'ERROR' AS severity, issue_code AS code, '' AS subject,
  coalesce(detail, '') AS detail FROM formats WHERE issue_code IS NOT NULL""")
def _(t):
    return detect.detection_issues(detect.classify_format(t.fx_tree))


@query("detection_report", f"""
WITH {CLASSIFY} SELECT coalesce(format, 'refused') AS format, issue_code, count(*) AS backups,
  CAST(sum(coalesce(shard_count, 0)) AS BIGINT) AS shards FROM formats GROUP BY 1, 2""")
def detection_report(t):
    """Convertible backups by format and refused ones by reason."""
    return detect.classify_format(t.fx_tree).groupBy(
        F.coalesce("format", F.lit("refused")).alias("format"), "issue_code").agg(
        F.count("*").alias("backups"),
        F.sum(F.coalesce("shard_count", F.lit(0))).alias("shards"))


@query("all_input_issues", f"""
WITH {CLASSIFY} SELECT backup_id, 'ERROR' AS severity, issue_code AS code FROM formats
WHERE issue_code IS NOT NULL
UNION ALL SELECT backup_id, 'WARN', 'UNMATCHED_SHARD_DIR' FROM fx_tree WHERE is_dir AND rel_dir = ''
  AND name = 'snapshot.shard1_0'
UNION ALL SELECT p.backup_id, 'ERROR', 'INPUT_UNREADABLE' FROM plan p
  JOIN fx_tree f USING (backup_id) WHERE f.rel_dir = '' AND f.name = '' AND NOT f.readable
UNION ALL SELECT p.backup_id, 'ERROR', 'SHARD_DIR_UNREADABLE' FROM planned p
  JOIN fx_tree f ON f.backup_id = p.backup_id AND f.rel_dir = '' AND f.name = p.dir
  WHERE f.name <> '' AND f.is_dir AND NOT f.readable
UNION ALL SELECT p.backup_id, 'ERROR', 'SHARD_DIR_UNREADABLE' FROM planned p
  JOIN fx_tree f ON f.backup_id = p.backup_id AND f.rel_dir = '' AND f.name = p.dir
  WHERE f.name = '' AND f.is_dir AND NOT f.readable
UNION ALL SELECT p.backup_id, 'ERROR', 'SHARD_DIR_MISSING' FROM planned p
  LEFT JOIN fx_tree f ON f.backup_id = p.backup_id AND f.rel_dir = '' AND f.name = p.dir AND f.is_dir
  WHERE f.backup_id IS NULL""")
def _(t):
    tree = t.fx_tree
    # what several checks read is written down: the folders
    folders = materialized(tree.filter("is_dir"), "folders")
    formats = materialized(detect.classify_format(tree), "formats")
    shards = detect.plan_shards(formats, detect.shard_dirs(folders), detect.standalone_index(tree))
    planned = formats.filter(F.col("format").isNotNull())
    return union_issues(
        detect.detection_issues(formats), detect.unmatched_shard_dirs(folders),
        validate.input_present(planned, shards, folders)).select("backup_id", "severity", "code")
