"""Schema mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions.values import utc_wall_clock
from ..operators import mapping, reconcile
from ..sources import schema
from .catalog import query

_PREFIX = f"starts_with(type, '{rules.TEXT_PREFIX}')"
_SHORTCUT = " ".join(f"WHEN type = '{k}' THEN '{v}'" for k, v in rules.TYPE_SHORTCUTS.items())
_CLASS = " ".join(f"WHEN contains(class, '{k}') THEN '{v}'" for k, v in rules.CLASS_RULES)

MAPPED = f"""
declared AS (SELECT backup_id, name AS type, arg_max(class, pos) AS class FROM fx_types GROUP BY 1, 2),
found AS (
  SELECT f.backup_id, f.pos, f.name AS field, f.type, coalesce(d.class, '') AS class
  FROM fx_fields f LEFT JOIN declared d ON d.backup_id = f.backup_id AND d.type = f.type
  WHERE f.name = '_text_' OR NOT starts_with(f.name, '_')),
steps AS (
  SELECT *, CASE WHEN {_PREFIX} THEN 'text' END AS s1, CASE {_SHORTCUT} END AS s2,
    CASE {_CLASS} END AS s3 FROM found),
mapped AS (
  SELECT backup_id, pos, field, type,
    CASE WHEN s1 IS NULL AND s2 IS NULL THEN class ELSE '' END AS class,
    coalesce(s1, s2, s3, 'keyword') AS target_type,
    CASE WHEN s1 IS NOT NULL THEN 'prefix' WHEN s2 IS NOT NULL THEN 'shortcut'
      WHEN s3 IS NOT NULL THEN 'class' ELSE 'default' END AS rule FROM steps),
final AS (
  SELECT backup_id, field, arg_max(target_type, pos) AS target_type, arg_max(rule, pos) AS rule
  FROM mapped GROUP BY backup_id, field)"""


def _mapped(t):
    return mapping.map_field_types(mapping.visible_fields(t.fx_fields), t.fx_types)


def _final(t):
    return mapping.final_mapping(_mapped(t))


@query("schema_fields", """
SELECT 'p' || p_partkey AS backup_id, CAST(e.pos AS BIGINT) AS pos, CASE e.pos WHEN 2 THEN replace(p_name, ' ', '_') WHEN 3 THEN ''
    ELSE 'last & least' END AS name,
  CASE e.pos WHEN 2 THEN 't' || p_size WHEN 3 THEN 'pint' ELSE lower(p_brand) END AS type
FROM part, (VALUES (2), (3), (6)) e(pos) WHERE p_partkey % 83 <> 0""")
def _(t):
    return schema.schema_fields(schema.schema_declarations(t.fx_schemas))


@query("schema_types", """
SELECT 'p' || p_partkey AS backup_id, CAST(e.pos AS BIGINT) AS pos, CASE e.pos WHEN 0 THEN 't' || p_size ELSE 'bare' END AS name,
  CASE e.pos WHEN 0 THEN 'solr.StrField' ELSE '' END AS class
FROM part, (VALUES (0), (1)) e(pos) WHERE p_partkey % 83 <> 0""")
def _(t):
    return schema.schema_types(schema.schema_declarations(t.fx_schemas))


@query("schema_counts", """
SELECT 'p' || p_partkey AS backup_id, CAST(CASE WHEN p_partkey % 83 = 0 THEN 0 ELSE 2 END AS BIGINT) AS types,
  CAST(CASE WHEN p_partkey % 83 = 0 THEN 0 ELSE 3 END AS BIGINT) AS fields,
  CAST(CASE WHEN p_partkey % 83 = 0 THEN 0 ELSE 2 END AS BIGINT) AS ignored_declarations,
  CAST(p_partkey % 83 = 0 AS BIGINT) AS errors FROM part""")
def _(t):
    return schema.schema_counts(schema.schema_declarations(t.fx_schemas))


@query("visible_fields", """
SELECT backup_id, pos, name, type FROM fx_fields WHERE name = '_text_' OR NOT starts_with(name, '_')""")
def _(t):
    return mapping.visible_fields(t.fx_fields)


@query("map_field_types", f"""
WITH {MAPPED} SELECT backup_id, pos, field, type, class, target_type, rule FROM mapped""")
def _(t):
    return _mapped(t)


@query("final_mapping", f"WITH {MAPPED} SELECT backup_id, field, target_type, rule FROM final")
def _(t):
    return _final(t)


@query("build_mapping", f"""
WITH {MAPPED},
placed AS (
  SELECT *, CAST('0x' || substring(md5(field), 1, 8) AS BIGINT) AS h,
    count(*) OVER (PARTITION BY backup_id) AS n FROM final),
chunks AS (
  SELECT backup_id, n, (h * CAST(ceil(n / 8) AS BIGINT)) >> 32 AS c,
    string_agg(CAST(to_json(field) AS VARCHAR) || ':{{"type":"' || target_type || '"}}', ',' ORDER BY h, field) AS body
  FROM placed GROUP BY 1, 2, 3)
SELECT backup_id, c AS part,
  CASE WHEN c = min(c) OVER (PARTITION BY backup_id) THEN '{{"_doc":{{"properties":{{' ELSE ',' END || body
    || CASE WHEN c = max(c) OVER (PARTITION BY backup_id) THEN '}}}}}}' ELSE '' END AS body FROM chunks""")
def _(t):
    return mapping.build_mapping(_final(t), fields_per_part=8)


@query("unknown_types", f"""
WITH {MAPPED} SELECT type, class, count(*) AS fields FROM mapped WHERE rule = 'default' GROUP BY 1, 2""")
def _(t):
    return mapping.unknown_types(_mapped(t))


@query("mapping_issues", f"""
WITH {MAPPED} SELECT backup_id, 'WARN' AS severity, 'TYPE_UNKNOWN' AS code, field AS subject, type AS detail
FROM mapped WHERE rule = 'default'
UNION ALL SELECT backup_id, 'WARN', 'FIELD_NAME_EMPTY', field, type FROM mapped WHERE field = ''""")
def _(t):
    return mapping.mapping_issues(_mapped(t))


@query("mapping_summary", f"""
WITH {MAPPED} SELECT backup_id, target_type, count(*) AS fields FROM final GROUP BY 1, 2
UNION ALL SELECT backup_id, NULL, count(*) FROM final GROUP BY 1""")
def _(t):
    return mapping.mapping_summary(_final(t))


@query("query_capability", f"""
WITH {MAPPED} SELECT backup_id, field, target_type, predicate FROM final JOIN (VALUES
  ('integer', 'term'), ('integer', 'range'), ('integer', 'aggregate'), ('long', 'term'), ('long', 'range'),
  ('long', 'aggregate'), ('float', 'term'), ('float', 'range'), ('float', 'aggregate'), ('double', 'term'),
  ('double', 'range'), ('double', 'aggregate'), ('date', 'term'), ('date', 'range'), ('date', 'aggregate'),
  ('keyword', 'term'), ('text', 'match'), ('boolean', 'term')) c(target_type, predicate) USING (target_type)""")
def _(t):
    return mapping.query_capability(_final(t))


@query("typed_load", """
SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS total, CAST(o_custkey AS INTEGER) AS customer,
  o_orderdate AS placed, o_orderkey % 2 = 0 AS even,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey / 100.0 END AS lat,
  o_orderpriority AS raw FROM orders""")
def _(t):
    texts = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("placed"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("even"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("nowhere")).otherwise(
            F.concat((F.col("o_custkey") / 100.0).cast("string"), F.lit(", 7.5"))).alias("place"),
        F.base64(F.col("o_orderpriority").cast("binary")).alias("raw"))
    loaded = mapping.typed_load(texts, {
        "id": "long", "state": "keyword", "total": "double", "customer": "integer",
        "placed": "date", "even": "boolean", "place": "geo_point", "raw": "binary"})
    return loaded.select("id", "state", "total", "customer",
                         utc_wall_clock(F.col("placed")).alias("placed"),
                         "even", F.col("place.lat").alias("lat"),
                         F.col("raw").cast("string").alias("raw"))


@query("reconcile_schema", """
WITH s AS (SELECT backup_id, field, target_type FROM fx_supplier_fields),
r AS (SELECT backup_id, CASE WHEN length(field) % 5 = 0 AND ends_with(field, '1') THEN field || 'x' ELSE field END AS field,
  CASE WHEN ends_with(field, '7') THEN 'long' ELSE target_type END AS target_type
  FROM fx_supplier_fields WHERE NOT ends_with(field, '3'))
SELECT backup_id, field, s.target_type AS source_type, r.target_type AS restored_type,
  CASE WHEN r.target_type IS NULL THEN 'missing' WHEN s.target_type IS NULL THEN 'extra'
    WHEN s.target_type <> r.target_type THEN 'retyped' ELSE 'same' END AS status
FROM s FULL JOIN r USING (backup_id, field)""")
def _(t):
    source = t.fx_supplier_fields
    field = F.col("field")
    renamed = F.when((F.length(field) % 5 == 0) & field.endswith("1"), F.concat(field, F.lit("x")))
    restored = source.filter(~field.endswith("3")).withColumn(
        "target_type", F.when(field.endswith("7"), F.lit("long")).otherwise(F.col("target_type"))
    ).withColumn("field", F.coalesce(renamed, field))
    return reconcile.reconcile_schema(source, restored)
