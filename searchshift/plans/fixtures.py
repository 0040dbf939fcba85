"""Derived tables that turn the driver tables into backups, schemas and snapshots.

The text is common to Spark SQL and to the oracle engine. ``EACH(a, b, ...)`` stands for
one row per listed value, which the two spell differently. Derivations use no window and
no join, so they scale like the scans they are made of.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import task_count

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FIXTURES = {
    # --- input trees: one backup per order (sharded) and per customer (single index)
    "fx_lines": """
        SELECT 'o' || CAST(l_orderkey AS STRING) AS backup_id,
          CASE WHEN l_partkey % 97 = 0 THEN 'snapshot.shard1_0'
               WHEN l_suppkey % 50 = 7 THEN 'snapshot.shard0'
               WHEN l_suppkey % 50 = 9 THEN 'snapshot.shard99999999999'
               WHEN l_suppkey % 16 = 0
                 THEN 'snapshot.shard0' || CAST(CAST(floor((l_linenumber + 1) / 2) AS INT) AS STRING)
               ELSE 'snapshot.shard' || CAST(CAST(floor((l_linenumber + 1) / 2) AS INT) AS STRING)
          END AS dir,
          l_partkey, l_suppkey, l_linenumber,
          CAST(floor(l_extendedprice) AS BIGINT) AS bytes
        FROM lineitem""",
    "fx_dirs": "SELECT DISTINCT backup_id, dir FROM fx_lines",
    "fx_commits": """
        SELECT DISTINCT backup_id, dir,
          'segments_' || substring('123456789abcdefghijz', CAST(1 + l_partkey % 20 AS INT), 1)
            || CASE WHEN l_partkey % 3 = 0 THEN '0' ELSE '' END AS name
        FROM fx_lines WHERE l_suppkey % 20 <> 0""",
    "fx_markers": """
        SELECT 'o' || CAST(o_orderkey AS STRING) AS backup_id,
          CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0 THEN ''
               WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 1 THEN 'child'
               WHEN o_orderpriority = '1-URGENT' THEN 'child/deeper'
               WHEN o_orderpriority = '2-HIGH' THEN 'zk_backup/configs/_default'
               WHEN o_orderpriority = '3-MEDIUM' THEN 'zk_backup_0/configs/_default'
               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'conf'
               ELSE '' END AS rel_dir,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'backup_0.properties'
               WHEN o_orderpriority = '5-LOW' THEN 'backup.properties'
               WHEN o_orderkey % 2 = 0 THEN 'managed-schema.xml'
               ELSE 'managed-schema' END AS name
        FROM orders""",
    "fx_tree": """
        SELECT 'o' || CAST(o_orderkey AS STRING) AS backup_id, '' AS rel_dir, '' AS name,
          o_orderkey % 41 <> 0 AS is_dir, CAST(0 AS BIGINT) AS length,
          o_orderkey % 43 <> 0 AS readable FROM orders
        UNION ALL SELECT backup_id, '', dir, true, CAST(0 AS BIGINT),
          dir <> 'snapshot.shard4' FROM fx_dirs
        UNION ALL SELECT backup_id, dir, name, false, CAST(137 AS BIGINT), true FROM fx_commits
        UNION ALL SELECT backup_id, dir, '_' || CAST(l_partkey AS STRING) || '_'
          || CAST(l_suppkey AS STRING) || '.cfs', false, bytes, true FROM fx_lines
        UNION ALL SELECT backup_id, rel_dir, name, false, CAST(10 AS BIGINT), true FROM fx_markers
        UNION ALL SELECT 'o' || CAST(o_orderkey AS STRING), 'conf', 'managed-schema.xml', false,
          CAST(11 AS BIGINT), true FROM orders
          WHERE o_orderkey % 5 = 0 AND o_orderpriority <> '4-NOT SPECIFIED'
        UNION ALL SELECT 'c' || CAST(c_custkey AS STRING), '', '', true, CAST(0 AS BIGINT), true
          FROM customer
        UNION ALL SELECT 'c' || CAST(c_custkey AS STRING),
          CASE WHEN c_nationkey % 4 = 1 THEN 'index' WHEN c_nationkey % 4 = 2 THEN 'data' ELSE '' END,
          CASE c_nationkey % 4 WHEN 3 THEN 'readme.txt' ELSE 'segments_1a' END, false,
          CAST(20 AS BIGINT), true FROM customer
        UNION ALL SELECT 'c' || CAST(c_custkey AS STRING), 'index', 'segments_' ||
          CAST(c_nationkey AS STRING), false, CAST(21 AS BIGINT), true FROM customer
          WHERE c_custkey % 6 = 0""",
    "fx_planned": """
        SELECT DISTINCT backup_id, CAST(floor((l_linenumber + 1) / 2) AS BIGINT) - 1 AS shard_id,
          'snapshot.shard' || CAST(CAST(floor((l_linenumber + 1) / 2) AS INT) AS STRING) AS dir
        FROM fx_lines
        UNION ALL SELECT 'm' || CAST(c_custkey AS STRING), CAST(c_nationkey % 2 AS BIGINT),
          'snapshot.shard1' FROM customer WHERE c_custkey % 10 = 0""",
    "fx_states": """
        SELECT 'o' || CAST(o_orderkey AS STRING) AS backup_id, 0 AS dir_rank,
          CASE WHEN o_custkey % 7 = 0 THEN 'not-json'
               WHEN o_custkey % 11 = 0 THEN '{"coll":{"router":"x"}}'
               WHEN o_custkey % 13 = 0 THEN '{"z":{"replicationFactor":3},"a":{"replicationFactor":7}}'
               WHEN o_custkey % 17 = 0 THEN '{"coll":{"replicationFactor":"many"}}'
               WHEN o_custkey % 5 = 0 THEN '{"coll":{"replicationFactor":"'
                 || CAST(o_custkey % 4 AS STRING) || '"}}'
               ELSE '{"coll":{"router":{"name":"compositeId"},"replicationFactor":'
                 || CAST(o_custkey % 4 AS STRING) || ',"shards":{"shard1":{}}}}' END AS content
        FROM orders WHERE o_custkey % 3 <> 0
        UNION ALL SELECT 'o' || CAST(o_orderkey AS STRING), 1,
          '{"coll":{"replicationFactor":' || CAST(1 + o_orderkey % 3 AS STRING) || '}}'
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT 'o' || CAST(o_orderkey AS STRING), 1, '' FROM orders
        WHERE o_orderkey % 2 = 1 AND o_custkey % 3 = 0""",
    # --- schemas: one backup per forty parts
    "fx_types": """
        SELECT 'p' || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS backup_id,
          p_partkey AS pos,
          CASE p_partkey % 14 WHEN 0 THEN 'string' WHEN 1 THEN 'text_general' WHEN 2 THEN 'text_odd'
            WHEN 3 THEN 'pint' WHEN 4 THEN 'pints' WHEN 5 THEN 'trie_long' WHEN 6 THEN 'old_float'
            WHEN 7 THEN 'sorttext' WHEN 8 THEN 'location' WHEN 9 THEN 'date' WHEN 10 THEN 'drange'
            WHEN 11 THEN 'flag' WHEN 12 THEN 'custom' ELSE 'noclass' END AS name,
          CASE p_partkey % 14 WHEN 0 THEN 'solr.StrField' WHEN 1 THEN 'solr.TextField'
            WHEN 2 THEN 'solr.StrField'
            WHEN 3 THEN 'solr.IntPointField'
            WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN 'solr.IntPointField' ELSE 'solr.DoublePointField' END
            WHEN 5 THEN CASE WHEN p_size % 2 = 0 THEN 'org.apache.solr.schema.TrieLongField'
              ELSE 'solr.TrieDateField' END
            WHEN 6 THEN 'solr.FloatField' WHEN 7 THEN 'solr.SortableTextField'
            WHEN 8 THEN 'solr.LatLonPointSpatialField' WHEN 9 THEN 'solr.TextField'
            WHEN 10 THEN 'solr.DateRangeField' WHEN 11 THEN 'solr.BoolField'
            WHEN 12 THEN 'com.example.CustomFieldType' ELSE '' END AS class
        FROM part""",
    "fx_fields": """
        SELECT 'p' || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS backup_id,
          p_partkey AS pos,
          CASE p_partkey % 25 WHEN 0 THEN '_version_' WHEN 1 THEN '_text_' WHEN 2 THEN '_root_'
            WHEN 3 THEN '' ELSE replace(p_name, ' ', '_') END AS name,
          CASE p_partkey % 15 WHEN 0 THEN 'string' WHEN 1 THEN 'text_general' WHEN 2 THEN 'text_odd'
            WHEN 3 THEN 'pint' WHEN 4 THEN 'pints' WHEN 5 THEN 'trie_long' WHEN 6 THEN 'old_float'
            WHEN 7 THEN 'sorttext' WHEN 8 THEN 'location' WHEN 9 THEN 'date' WHEN 10 THEN 'drange'
            WHEN 11 THEN 'flag' WHEN 12 THEN 'custom' WHEN 13 THEN 'noclass' ELSE 'undeclared' END AS type
        FROM part""",
    "fx_schemas": """
        SELECT 'p' || CAST(p_partkey AS STRING) AS backup_id,
          '<?xml version="1.0" encoding="UTF-8"?><schema name="s"><types><fieldType name="t'
          || CAST(p_size AS STRING) || '" class="solr.StrField"/><fieldType name="bare"/></types>'
          || '<fields><!-- <field name="hidden" type="string"/> --><field name="'
          || replace(p_name, ' ', '_') || '" type="t' || CAST(p_size AS STRING)
          || '" indexed="true"/><group><field type="pint">x</field></group>'
          || '<dynamicField name="*_i" type="pint"/><copyField source="a" dest="b"/></fields>'
          || CASE WHEN p_partkey % 83 = 0 THEN '<oops></schema>' ELSE '<field name="last &amp; least" type="'
          || lower(p_brand) || '"/></schema>' END AS content
        FROM part""",
    # --- shards, segments, manifests: one backup per supplier, seven shards
    "fx_segments": """
        SELECT 's' || CAST(l_suppkey AS STRING) AS backup_id,
          CAST(l_linenumber - 1 AS BIGINT) AS shard_id,
          CASE WHEN l_suppkey % 10 = 4 AND l_linenumber = 6 THEN NULL
            ELSE '_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_partkey AS STRING) END AS segment,
          CASE WHEN l_suppkey % 10 = 3 AND l_linenumber = 5 THEN CAST(0 AS BIGINT)
               WHEN l_suppkey % 10 = 4 AND l_linenumber = 6 THEN NULL
            ELSE CAST(floor(l_quantity) AS BIGINT) END AS max_doc,
          CASE WHEN l_suppkey % 13 = 0 THEN '6.6.6' WHEN l_suppkey % 11 = 0 THEN '7.7.3'
            WHEN l_suppkey % 2 = 0 THEN '8.11.4' ELSE '9.8.0' END AS lucene_version,
          l_suppkey % 14 = 1 AND l_linenumber = 2 AS unreadable
        FROM lineitem""",
    "fx_shards": """
        SELECT DISTINCT 's' || CAST(l_suppkey AS STRING) AS backup_id,
          CAST(l_linenumber - 1 AS BIGINT) AS shard_id FROM lineitem
        UNION ALL SELECT 's' || CAST(s_suppkey AS STRING), CAST(7 AS BIGINT) FROM supplier
          WHERE s_suppkey % 9 = 0""",
    "fx_files": """
        SELECT backup_id, shard_id, segment || ext AS name, length FROM (
          SELECT 's' || CAST(l_suppkey AS STRING) AS backup_id,
            CAST(l_linenumber - 1 AS BIGINT) AS shard_id, l_orderkey,
            '_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_partkey AS STRING) AS segment,
            EACH('.fdt', '.fdx', '.si') AS ext,
            CAST(floor(l_extendedprice) AS BIGINT) AS length
          FROM lineitem) f WHERE NOT (ext = '.fdx' AND l_orderkey % 53 = 0)
        UNION ALL SELECT 's' || CAST(l_suppkey AS STRING), CAST(l_linenumber - 1 AS BIGINT),
          '_old_' || CAST(l_orderkey AS STRING) || '.fdt', CAST(1 AS BIGINT)
        FROM lineitem WHERE l_partkey % 29 = 0""",
    "fx_manifest": """
        SELECT 's' || CAST(l_suppkey AS STRING) AS backup_id,
          CAST(l_linenumber - 1 AS BIGINT) AS shard_id,
          '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_orderkey AS STRING) || '.fdt' AS name,
          CAST(floor(l_extendedprice) AS BIGINT) AS length,
          substring(md5(CAST(l_orderkey AS STRING)), 1, 8) AS checksum,
          CASE l_returnflag WHEN 'A' THEN '9.8.0' WHEN 'N' THEN '8.11.4' ELSE '7.7.3' END AS written_by
        FROM lineitem""",
    "fx_supplier_fields": """
        SELECT 's' || CAST(p_partkey % 197 AS STRING) AS backup_id, 'f' || CAST(p_partkey AS STRING)
          || CASE WHEN p_size = 1 THEN '"q"' ELSE '' END AS field,
          CASE p_size % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'keyword' WHEN 2 THEN 'long' ELSE 'date' END
            AS target_type
        FROM part""",
    "fx_volumes": """
        SELECT 'o' || CAST(o_orderkey AS STRING) AS backup_id,
          CAST(floor(o_totalprice) AS BIGINT) AS usable,
          '/out/' || CAST(o_orderkey AS STRING) AS output_dir,
          CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS BIGINT)
            ELSE -CAST(o_orderkey AS BIGINT) END AS device,
          o_orderkey % 31 <> 0 AS writable,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 4 END AS entries
        FROM orders""",
    # --- output trees: one repository per customer
    "fx_out_entries": """
        SELECT c_custkey, EACH(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16) AS k
        FROM customer WHERE c_custkey % 29 <> 13""",
    "fx_out": """
        SELECT 'c' || CAST(c_custkey AS STRING) AS backup_id,
          CASE WHEN k < 5 THEN '' WHEN k IN (5, 15) THEN 'indices' WHEN k IN (6, 7, 11) THEN 'indices/ix'
            WHEN k < 11 THEN 'indices/ix/0' WHEN k < 15 THEN 'indices/ix/1' ELSE 'indices/iy' END AS rel_dir,
          CASE k WHEN 0 THEN 'index-0' WHEN 1 THEN 'index.latest' WHEN 2 THEN 'snap-x.dat'
            WHEN 3 THEN 'meta-x.dat' WHEN 4 THEN 'indices' WHEN 5 THEN 'ix' WHEN 6 THEN 'meta-m.dat'
            WHEN 7 THEN '0' WHEN 8 THEN 'snap-s.dat' WHEN 9 THEN 'index-g' WHEN 10 THEN 'segments_2'
            WHEN 11 THEN '1' WHEN 12 THEN 'snap-s.dat' WHEN 13 THEN 'index-g' WHEN 14 THEN '_0.fdt'
            WHEN 15 THEN 'iy' ELSE 'meta-m.dat' END AS name,
          k IN (4, 5, 7, 11, 15) AS is_dir,
          CAST(CASE WHEN k IN (4, 5, 7, 11, 15) THEN 0
            WHEN k = 1 AND c_custkey % 7 <> 3 THEN 8 ELSE 100 + k END AS BIGINT) AS length,
          true AS readable
        FROM fx_out_entries
        WHERE (k < 15 OR c_custkey % 19 = 3) AND NOT (c_custkey % 34 = k OR (c_custkey % 34 = 4 AND k > 4)
          OR (c_custkey % 34 = 5 AND k BETWEEN 6 AND 14) OR (c_custkey % 34 = 7 AND k BETWEEN 8 AND 10)
          OR (c_custkey % 34 = 11 AND k BETWEEN 12 AND 14))""",
    "fx_out_shards": """
        SELECT 'c' || CAST(c_custkey AS STRING) AS backup_id, CAST(k AS BIGINT) AS shard_id
        FROM (SELECT c_custkey, EACH(0, 1, 2) AS k FROM customer) s
        WHERE k < 2 OR c_custkey % 23 = 0""",
    # --- restored data and cluster replies
    "fx_restored": """
        SELECT CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
          o_custkey, o_orderstatus,
          CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          o_orderdate, CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderkey % 97 <> 0""",
    "fx_status": """
        SELECT 'k' || CAST(o_orderkey AS STRING) AS cluster_id,
          '{"cluster":{"live_nodes":["n' || CAST(o_custkey % 5 AS STRING) || '","a1","n9"],'
          || '"collections":{"coll' || CAST(o_custkey AS STRING) || '":{'
          || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '"replicationFactor":"'
             || CAST(o_orderkey % 3 AS STRING) || '",' END
          || '"shards":{"shard1":{"replicas":{"r1":{"leader":"true","node_name":"n'
          || CAST(o_custkey % 5 AS STRING) || '"},"r2":{"node_name":"a1"}}},'
          || '"shard2":{"replicas":{' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE
             '"r3":{"leader":"false","node_name":"a1"}' END || '}}}}}}}' AS content,
          CAST(o_orderkey % 3 + 2 AS INT) AS expected_nodes
        FROM orders""",
    "fx_health": """
        SELECT event_id, 'i' || CAST(user_id AS STRING) AS index_name, ts,
          CASE WHEN event_id % 29 = 0 THEN 'curl: (7) refused'
            ELSE '{"number_of_nodes":' || CAST(event_id % 5 AS STRING) || ',"status":"'
              || CASE WHEN value >= 15 THEN 'green' WHEN value >= 8 THEN 'yellow' ELSE 'red' END
              || '"}' END AS content
        FROM events""",
    "fx_settings": """
        SELECT 'o' || CAST(o_orderkey AS STRING) AS backup_id,
          CAST(o_custkey % 4 + 1 AS INT) AS shard_count,
          CAST(o_orderkey % 3 + 1 AS INT) AS replication_factor,
          '{"index":{"number_of_replicas":"' || CAST((o_orderkey % 3) AS STRING) || '"}}' AS settings,
          '{"status":"' || CASE WHEN o_orderkey % 7 = 0 THEN 'yellow' ELSE 'green' END
            || '","active_primary_shards":' || CAST(o_custkey % 4 + 1 AS STRING)
            || ',"active_shards":' || CAST((o_custkey % 4 + 1) * (o_orderkey % 3 + 1)
               - CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS STRING) || '}' AS health
        FROM orders""",
    "fx_copies": """
        SELECT CAST(l_suppkey % 8 AS INT) AS shard, CASE l_linestatus WHEN 'O' THEN 'p' ELSE 'r' END
          AS prirep, CAST(floor(l_quantity) AS BIGINT) AS docs FROM lineitem""",
}

#: Tables of few bytes and many rows, of which a fixture makes several rows each: they come in one
#: split or two, so their rows are dealt out before they are multiplied.
DEALT_OUT = {"fx_out_entries": ("customer", "c_custkey"), "fx_out_shards": ("customer", "c_custkey")}

_EACH = re.compile(r"EACH\(([^()]*)\)")
_WORD = re.compile(r"\b[a-z_]+\b")


def _dependencies(names: list[str]) -> tuple[list[str], list[str]]:
    """Fixtures (in definition order) and driver tables behind the given names."""
    needed, tables, todo = set(), set(), list(names)
    while todo:
        name = todo.pop()
        if name in TABLES:
            tables.add(name)
        elif name in FIXTURES and name not in needed:
            needed.add(name)
            todo += _WORD.findall(FIXTURES[name])
    return [f for f in FIXTURES if f in needed], sorted(tables)


def _with_clause(names: list[str], each: str) -> str:
    return ",\n".join(f"{n} AS ({_EACH.sub(each, FIXTURES[n])})" for n in names)


def oracle_text(sql: str) -> str:
    """Oracle SQL with the fixtures it mentions put in front."""
    names, _ = _dependencies(_WORD.findall(sql))
    sql = _EACH.sub(r"unnest([\1])", sql)
    if not names:
        return sql
    clause = _with_clause(names, r"unnest([\1])")
    if sql.lstrip().startswith("WITH "):
        return f"WITH {clause},\n{sql.lstrip()[5:]}"
    return f"WITH {clause}\n{sql}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a fixture as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names, tables = _dependencies([name])
    dealt = dict(DEALT_OUT[n] for n in names if n in DEALT_OUT)
    for t in tables:
        rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if t in dealt:
            rows = rows.repartition(task_count(spark), dealt[t])
        rows.createOrReplaceTempView(t)
    return spark.sql(f"WITH {_with_clause(names, r'explode(array(\1))')}\nSELECT * FROM {name}")
