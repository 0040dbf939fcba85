"""Schema mapping: source field types to target field types.

``fields`` is (backup_id, pos, name, type), ``types`` is (backup_id, pos, name, class);
``pos`` is the place in the schema document, and of a repeated name the last counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import json_text
from .documents import list_parts, text_hash
from .issues import issue_rows
from .joins import join_parents

RULES = ("prefix", "shortcut", "class", "default")
_CODES = len(rules.TARGET_TYPES) * len(RULES)


def _choice(rule: str, target: str) -> Column:
    """Rule and target type as one small number."""
    return F.lit(RULES.index(rule) * len(rules.TARGET_TYPES) + rules.TARGET_TYPES.index(target))


def _target(code: Column) -> Column:
    names = F.array(*[F.lit(t) for t in rules.TARGET_TYPES])
    return F.get(names, (code % len(rules.TARGET_TYPES)).cast("int"))


def _rule(code: Column) -> Column:
    names = F.array(*[F.lit(r) for r in RULES])
    return F.get(names, F.floor(code / len(rules.TARGET_TYPES)).cast("int"))


def _decide(type_name: Column, class_name: Column) -> Column:
    """The four mapping steps as one conditional chain, first match wins."""
    decision = F.when(type_name.startswith(rules.TEXT_PREFIX), _choice("prefix", "text"))
    by_target: dict[str, list[str]] = {}
    for name, target in rules.TYPE_SHORTCUTS.items():
        by_target.setdefault(target, []).append(name)
    for target, names in by_target.items():
        decision = decision.when(type_name.isin(*names), _choice("shortcut", target))
    for fragment, target in rules.CLASS_RULES:
        decision = decision.when(class_name.contains(fragment), _choice("class", target))
    return decision.otherwise(_choice("default", rules.DEFAULT_TARGET))


def visible_fields(fields: DataFrame) -> DataFrame:
    """Fields without the internal ones, keeping the catch-all text field."""
    return fields.filter(~F.col("name").startswith(rules.INTERNAL_PREFIX)
                         | (F.col("name") == rules.INTERNAL_KEPT))


def declared_types(types: DataFrame) -> DataFrame:
    """One class per type name; the last declaration counts."""
    return types.groupBy("backup_id", F.col("name").alias("type")).agg(
        F.max_by("class", "pos").alias("class"))


def map_field_types(fields: DataFrame, types: DataFrame) -> DataFrame:
    """Target type and deciding rule of every field row.

    Only rows whose type name does not settle the matter need the class, so only
    they enter the join with the declared types.
    """
    by_name = F.col("type").startswith(rules.TEXT_PREFIX) | F.col("type").isin(
        *rules.TYPE_SHORTCUTS)
    named = fields.filter(by_name).withColumn("class", F.lit(""))
    classed = (
        join_parents(fields.filter(~by_name), declared_types(types), ["backup_id", "type"],
                     spread=["pos", "name"], how="left")
        .withColumn("class", F.coalesce("class", F.lit("")))
    )
    return (
        named.unionByName(classed)
        .withColumn("_code", _decide(F.col("type"), F.col("class")))
        .select("backup_id", "pos", F.col("name").alias("field"), "type", "class",
                _target(F.col("_code")).alias("target_type"), _rule(F.col("_code")).alias("rule"))
    )


def final_mapping(mapped: DataFrame) -> DataFrame:
    """One row per field name: the last declaration of a repeated name counts.

    Position and decision travel as one number, so the aggregation stays on fixed
    width buffers.
    """
    targets = F.array(*[F.lit(t) for t in rules.TARGET_TYPES])
    names = F.array(*[F.lit(r) for r in RULES])
    code = ((F.array_position(names, F.col("rule")) - 1) * len(rules.TARGET_TYPES)
            + F.array_position(targets, F.col("target_type")) - 1)
    latest = mapped.groupBy("backup_id", "field").agg(
        F.max(F.col("pos") * _CODES + code).alias("_latest"))
    last = F.pmod("_latest", F.lit(_CODES))
    return latest.select("backup_id", "field", _target(last).alias("target_type"),
                         _rule(last).alias("rule"))


def build_mapping(mapping: DataFrame, fields_per_part: int = 1000) -> DataFrame:
    """Mapping document of each backup as ordered text parts (backup_id, part, body).

    Joined in part order the bodies form one JSON document; a backup without fields
    has none. A part holds a bounded number of fields, however many the backup has.
    """
    entry = F.concat(json_text(F.col("field")), F.lit(':{"type":"'), F.col("target_type"),
                     F.lit('"}'))
    entries = mapping.select("backup_id", text_hash(F.col("field")).alias("place"),
                             F.col("field").alias("name"), entry.alias("body"))
    parts = list_parts(entries, ["backup_id"], fields_per_part)
    opening = F.when(F.col("is_first"), F.lit('{"_doc":{"properties":{')).otherwise(F.lit(""))
    closing = F.when(F.col("is_last"), F.lit("}}}")).otherwise(F.lit(""))
    return parts.select("backup_id", F.col("chunk").alias("part"),
                        F.concat(opening, F.col("body"), closing).alias("body"))


def unknown_types(mapped: DataFrame) -> DataFrame:
    """Types that fell back to the default, with the number of fields concerned."""
    return mapped.filter(F.col("rule") == "default").groupBy("type", "class").agg(
        F.count("*").alias("fields"))


def mapping_issues(mapped: DataFrame) -> DataFrame:
    """Warnings on unknown types and on fields without a name."""
    unknown = issue_rows(mapped.filter(F.col("rule") == "default"), "TYPE_UNKNOWN",
                         F.col("field"), F.col("type"))
    nameless = issue_rows(mapped.filter(F.col("field") == ""), "FIELD_NAME_EMPTY",
                          F.col("field"), F.col("type"))
    return unknown.unionByName(nameless)


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """Fields by target type in each backup; the total has a NULL type."""
    return mapping.rollup("backup_id", "target_type").agg(
        F.count("*").alias("fields")).filter(F.col("backup_id").isNotNull())


def query_capability(mapping: DataFrame) -> DataFrame:
    """Predicates that work on each field under its target type."""
    allowed = {t: [p for kind, p in rules.CAPABILITIES if kind == t] for t in rules.TARGET_TYPES}
    choice = F.lit(None).cast("array<string>")
    for target, predicates in allowed.items():
        choice = F.when(F.col("target_type") == target,
                        F.array(*[F.lit(p) for p in predicates]).cast("array<string>")
                        ).otherwise(choice)
    return mapping.select("backup_id", "field", "target_type", F.explode(choice).alias("predicate"))


def spark_schema(target_types: dict[str, str]) -> str:
    """DDL of the Spark columns that hold fields of the given target types."""
    return ", ".join(f"`{f}` {rules.SPARK_TYPES[t]}" for f, t in target_types.items())


def typed(column: Column, target: str) -> Column:
    """A text column under its target type; text that does not fit gives NULL."""
    if target == "date":
        return F.try_to_timestamp(column)
    if target == "binary":
        return F.unbase64(column)
    if target == "geo_point":
        lat, lon = (F.get(F.split(column, r"\s*,\s*"), i).try_cast("double") for i in (0, 1))
        return F.when(lat.isNotNull() & lon.isNotNull(),
                      F.struct(lat.alias("lat"), lon.alias("lon")))
    return column.try_cast(rules.SPARK_TYPES[target])


def typed_load(df: DataFrame, target_types: dict[str, str]) -> DataFrame:
    """Text columns cast to their mapped types."""
    return df.select(*[typed(F.col(f), t).alias(f) for f, t in target_types.items()])
