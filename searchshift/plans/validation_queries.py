"""Checks before and after a conversion, as issue rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validate
from ..operators.issues import union_issues
from ..session import materialized
from .catalog import query

_BYTES = """CASE WHEN {n} < 1024 THEN {n} || ' B'
  WHEN {n} < 1048576 THEN printf('%.1f KB', floor({n} * 10 / 1024 + 0.5) / 10)
  WHEN {n} < 1073741824 THEN printf('%.1f MB', floor({n} * 10 / 1048576 + 0.5) / 10)
  ELSE printf('%.2f GB', floor({n} * 100 / 1073741824 + 0.5) / 100) END"""


def bytes_sql(n: str) -> str:
    """Size text with halves rounded up, by arithmetic."""
    return _BYTES.format(n=n)


INPUT = """
expected AS (SELECT DISTINCT backup_id FROM fx_planned),
dirs AS (SELECT backup_id, name AS dir, readable FROM fx_tree WHERE is_dir AND rel_dir = ''),
roots AS (SELECT backup_id, readable FROM dirs WHERE dir = ''),
lost AS (SELECT backup_id FROM expected WHERE backup_id NOT IN (SELECT backup_id FROM roots)),
input_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'INPUT_MISSING' AS code, '' AS subject, '' AS detail FROM lost
  UNION ALL SELECT backup_id, 'ERROR', 'INPUT_UNREADABLE', '', '' FROM expected JOIN roots USING (backup_id)
    WHERE NOT readable
  UNION ALL SELECT p.backup_id, 'ERROR', CASE WHEN d.readable IS NULL THEN 'SHARD_DIR_MISSING'
      ELSE 'SHARD_DIR_UNREADABLE' END, 'shard ' || (p.shard_id + 1), p.dir
    FROM fx_planned p LEFT JOIN dirs d ON d.backup_id = p.backup_id AND d.dir = p.dir
    WHERE (d.readable IS NULL OR NOT d.readable) AND p.backup_id NOT IN (SELECT backup_id FROM lost))"""

OUTPUT_STATE = """
state_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'OUTPUT_NOT_WRITABLE' AS code, output_dir AS subject, '' AS detail
  FROM fx_volumes WHERE NOT writable
  UNION ALL SELECT backup_id, 'WARN', 'OUTPUT_NOT_EMPTY', output_dir, CAST(entries AS VARCHAR)
  FROM fx_volumes WHERE entries > 0)"""

HEALTH = """
commits AS (
  SELECT backup_id, shard_id, bool_or(unreadable) AS unreadable, max(lucene_version) AS version,
    CAST(split_part(max(lucene_version), '.', 1) AS INTEGER) AS major,
    count(segment) AS segments, coalesce(sum(max_doc), 0) AS docs FROM fx_segments GROUP BY 1, 2),
state AS (
  SELECT s.backup_id, 'shard ' || (s.shard_id + 1) AS label, version, major, segments, docs,
    coalesce(NOT unreadable, false) AS ok FROM fx_shards s LEFT JOIN commits c USING (backup_id, shard_id)),
health_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'LIBRARY_TOO_OLD' AS code, label AS subject, version AS detail
  FROM state WHERE ok AND major < 7
  UNION ALL SELECT backup_id, 'WARN', 'LIBRARY_OLD', label, version FROM state WHERE ok AND major = 7
  UNION ALL SELECT backup_id, 'WARN', 'NO_SEGMENTS', label, '' FROM state WHERE ok AND segments = 0
  UNION ALL SELECT backup_id, 'WARN', 'NO_DOCUMENTS', label, '' FROM state WHERE ok AND docs = 0
  UNION ALL SELECT backup_id, 'ERROR', 'COMMIT_UNREADABLE', label, '' FROM state WHERE NOT ok)"""

DISK = f"""
disk_issues AS (
  SELECT backup_id, 'WARN' AS severity, 'LOW_DISK_SPACE' AS code, '' AS subject,
    'need ' || {bytes_sql('required')} || ', have ' || {bytes_sql('usable')} AS detail
  FROM (SELECT backup_id, sum(need) OVER (PARTITION BY device) AS required, min(usable) OVER (PARTITION BY device) AS usable
    FROM (SELECT t.backup_id, CAST(floor(sum(t.length) * 1.1::DOUBLE) AS BIGINT) AS need
          FROM fx_tree t JOIN fx_planned p ON p.backup_id = t.backup_id AND p.dir = t.rel_dir
          WHERE NOT t.is_dir GROUP BY 1) i
    JOIN fx_volumes USING (backup_id) WHERE device IS NOT NULL) d WHERE usable < required)"""

REPO = """
top AS (SELECT s.backup_id, coalesce(bool_or(name = 'index-0'), false) AS a, coalesce(bool_or(name = 'index.latest'), false) AS b,
    coalesce(bool_or(name LIKE 'snap-%.dat'), false) AS c, coalesce(bool_or(name LIKE 'meta-%.dat'), false) AS d
  FROM fx_out_shards s LEFT JOIN fx_out o ON o.backup_id = s.backup_id AND o.rel_dir = '' GROUP BY 1),
repo_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'REPO_INDEX_MISSING' AS code, 'index-0' AS subject, '' AS detail
  FROM top WHERE NOT a
  UNION ALL SELECT backup_id, 'ERROR', 'REPO_LATEST_MISSING', 'index.latest', '' FROM top WHERE NOT b
  UNION ALL SELECT backup_id, 'ERROR', 'REPO_SNAPSHOT_MISSING', 'snap-*.dat', '' FROM top WHERE NOT c
  UNION ALL SELECT backup_id, 'ERROR', 'REPO_METADATA_MISSING', 'meta-*.dat', '' FROM top WHERE NOT d)"""

LATEST = """
latest_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'REPO_LATEST_SIZE' AS code, name AS subject,
    CAST(length AS VARCHAR) AS detail FROM fx_out
  WHERE rel_dir = '' AND name = 'index.latest' AND length <> 8)"""

INDEX_DIRS = """
picked AS (SELECT backup_id, min(name) AS index_dir, count(*) AS candidates FROM fx_out
  WHERE is_dir AND rel_dir = 'indices' GROUP BY 1),
level AS (
  SELECT r.backup_id, p.index_dir, p.candidates,
    EXISTS (SELECT 1 FROM fx_out o WHERE o.backup_id = r.backup_id AND o.rel_dir = '' AND o.name = 'indices' AND o.is_dir) AS has_indices,
    EXISTS (SELECT 1 FROM fx_out o WHERE o.backup_id = r.backup_id AND o.rel_dir = 'indices/' || p.index_dir
      AND o.name LIKE 'meta-%.dat') AS has_meta
  FROM (SELECT DISTINCT backup_id FROM fx_out_shards) r LEFT JOIN picked p USING (backup_id)),
shard_present AS (SELECT o.backup_id, o.name AS dir, o.rel_dir || '/' || o.name AS path FROM fx_out o
  JOIN picked p ON p.backup_id = o.backup_id AND o.rel_dir = 'indices/' || p.index_dir WHERE o.is_dir),
index_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'INDICES_DIR_MISSING' AS code, 'indices' AS subject, '' AS detail
  FROM level WHERE NOT has_indices
  UNION ALL SELECT backup_id, 'ERROR', 'INDEX_DIR_MISSING', 'indices', '' FROM level
    WHERE has_indices AND index_dir IS NULL
  UNION ALL SELECT backup_id, 'WARN', 'INDEX_DIR_MULTIPLE', index_dir, CAST(candidates AS VARCHAR) FROM level
    WHERE candidates > 1
  UNION ALL SELECT backup_id, 'ERROR', 'INDEX_METADATA_MISSING', index_dir, '' FROM level
    WHERE index_dir IS NOT NULL AND NOT has_meta
  UNION ALL SELECT s.backup_id, 'ERROR', 'OUTPUT_SHARD_MISSING', 'shard ' || (s.shard_id + 1), ''
    FROM fx_out_shards s WHERE NOT EXISTS (
      SELECT 1 FROM shard_present x WHERE x.backup_id = s.backup_id AND x.dir = CAST(s.shard_id AS VARCHAR)))"""

SHARD_FILES = """
shard_flags AS (
  SELECT x.backup_id, x.dir, coalesce(bool_or(o.name LIKE 'snap-%.dat'), false) AS snap,
    coalesce(bool_or(o.name LIKE 'index-%'), false) AS idx,
    count(CASE WHEN NOT (o.name LIKE 'snap-%.dat' OR o.name LIKE 'index-%') THEN 1 END) AS others
  FROM shard_present x JOIN fx_out_shards s ON s.backup_id = x.backup_id AND x.dir = CAST(s.shard_id AS VARCHAR)
  LEFT JOIN fx_out o ON o.backup_id = x.backup_id AND o.rel_dir = x.path GROUP BY 1, 2),
file_issues AS (
  SELECT backup_id, 'ERROR' AS severity, 'SHARD_SNAPSHOT_MISSING' AS code, 'shard ' || (dir::BIGINT + 1) AS subject, '' AS detail
  FROM shard_flags WHERE NOT snap
  UNION ALL SELECT backup_id, 'ERROR', 'SHARD_INDEX_MISSING', 'shard ' || (dir::BIGINT + 1), '' FROM shard_flags WHERE NOT idx
  UNION ALL SELECT backup_id, 'WARN', 'SHARD_FILES_MISSING', 'shard ' || (dir::BIGINT + 1), '' FROM shard_flags WHERE others = 0)"""

ALL = ",\n".join([INPUT, OUTPUT_STATE, HEALTH, DISK, REPO, LATEST, INDEX_DIRS, SHARD_FILES]) + """,
issues AS (
  SELECT * FROM input_issues UNION ALL SELECT * FROM state_issues UNION ALL SELECT * FROM health_issues
  UNION ALL SELECT * FROM disk_issues UNION ALL SELECT * FROM repo_issues UNION ALL SELECT * FROM latest_issues
  UNION ALL SELECT * FROM index_issues UNION ALL SELECT * FROM file_issues)"""


#: Place of each check that these queries can raise, written out by hand.
ORDER = """
ordered(code, check_order) AS (VALUES ('INPUT_MISSING', 11), ('INPUT_UNREADABLE', 12), ('SHARD_DIR_MISSING', 13),
  ('SHARD_DIR_UNREADABLE', 14), ('OUTPUT_NOT_WRITABLE', 15), ('OUTPUT_NOT_EMPTY', 16), ('LIBRARY_TOO_OLD', 17),
  ('LIBRARY_OLD', 18), ('NO_SEGMENTS', 19), ('NO_DOCUMENTS', 20), ('COMMIT_UNREADABLE', 21), ('LOW_DISK_SPACE', 23),
  ('REPO_INDEX_MISSING', 33), ('REPO_LATEST_MISSING', 34), ('REPO_SNAPSHOT_MISSING', 35), ('REPO_METADATA_MISSING', 36),
  ('REPO_LATEST_SIZE', 37), ('INDICES_DIR_MISSING', 38), ('INDEX_DIR_MISSING', 39), ('INDEX_DIR_MULTIPLE', 40),
  ('INDEX_METADATA_MISSING', 41), ('OUTPUT_SHARD_MISSING', 42), ('SHARD_SNAPSHOT_MISSING', 43),
  ('SHARD_INDEX_MISSING', 44), ('SHARD_FILES_MISSING', 45))"""


def _input(t, planned):
    folders = materialized(t.fx_tree.filter("is_dir"), "folders")
    return validate.input_present(planned.select("backup_id").distinct(), planned, folders)


def _disk(t, planned):
    return validate.disk_space(validate.input_bytes(t.fx_tree, planned), t.fx_volumes)


def _all(t):
    # what several checks read is written down; of the input trees one reads the folders, one the files
    planned, out = materialized(t.fx_planned, "planned"), materialized(t.fx_out, "outputs")
    expected = t.fx_out_shards
    return union_issues(
        _input(t, planned), validate.output_state(t.fx_volumes),
        validate.segment_health(t.fx_shards, t.fx_segments), _disk(t, planned),
        validate.repo_files(out, expected), validate.index_latest_size(out),
        validate.index_dirs(out, expected), validate.shard_files(out, expected))


@query("input_present", f"WITH {INPUT} SELECT * FROM input_issues")
def _(t):
    return _input(t, materialized(t.fx_planned, "planned"))


@query("output_state", f"WITH {OUTPUT_STATE} SELECT * FROM state_issues")
def _(t):
    return validate.output_state(t.fx_volumes)


@query("segment_health", f"WITH {HEALTH} SELECT * FROM health_issues")
def _(t):
    return validate.segment_health(t.fx_shards, t.fx_segments)


@query("disk_space", f"WITH {DISK} SELECT * FROM disk_issues")
def _(t):
    return _disk(t, t.fx_planned)


@query("validation_gate", f"""
WITH {HEALTH} SELECT DISTINCT backup_id FROM fx_shards
WHERE backup_id NOT IN (SELECT backup_id FROM health_issues WHERE severity = 'ERROR')""")
def _(t):
    shards = t.fx_shards
    return validate.validation_gate(
        shards.select("backup_id").distinct(), validate.segment_health(shards, t.fx_segments))


@query("repo_files", f"WITH {REPO} SELECT * FROM repo_issues")
def _(t):
    return validate.repo_files(t.fx_out, t.fx_out_shards)


@query("index_latest_size", f"WITH {LATEST} SELECT * FROM latest_issues")
def _(t):
    return validate.index_latest_size(t.fx_out)


@query("pick_index_dir", f"WITH {INDEX_DIRS} SELECT * FROM picked")
def _(t):
    return validate.pick_index_dir(t.fx_out)


@query("index_dirs", f"WITH {INDEX_DIRS} SELECT * FROM index_issues")
def _(t):
    return validate.index_dirs(t.fx_out, t.fx_out_shards)


@query("shard_files", f"WITH {INDEX_DIRS}, {SHARD_FILES} SELECT * FROM file_issues")
def _(t):
    return validate.shard_files(t.fx_out, t.fx_out_shards)


@query("issue_summary", f"""
WITH {ALL}, {ORDER} SELECT s.*, check_order FROM (
  SELECT severity, code, count(*) AS issues, count(DISTINCT backup_id) AS backups
  FROM issues GROUP BY ROLLUP (severity, code)) s LEFT JOIN ordered o ON o.code = s.code""")
def _(t):
    return validate.issue_summary(_all(t))


@query("issue_report", f"""
WITH {ALL}, {ORDER} SELECT backup_id, severity, code, subject, detail, severity = 'ERROR' AS is_error, check_order
FROM issues JOIN ordered USING (code)""")
def _(t):
    return validate.report(_all(t))
