import json

import pytest
from pyspark.sql import functions as F

from searchshift import rules
from searchshift.operators import mapping
from searchshift.sources import schema

CLASSES = [(f"{prefix}{kind}{suffix}", target)
           for prefix, suffix in (("", "PointField"), ("Trie", "Field"), ("", "Field"))
           for kind, target in (("Int", "integer"), ("Long", "long"), ("Float", "float"),
                                ("Double", "double"), ("Date", "date"))]
CLASSES += [("StrField", "keyword"), ("TextField", "text"), ("BoolField", "boolean"),
            ("BinaryField", "binary"), ("LatLonPointSpatialField", "geo_point"),
            ("SpatialRecursivePrefixTreeFieldType", "geo_point"), ("SortableTextField", "text"),
            ("DateRangeField", "keyword"), ("CurrencyField", "keyword"), ("", "keyword")]


def mapped(spark, fields, types):
    f = spark.createDataFrame([("b", i, n, t) for i, (n, t) in enumerate(fields)],
                              "backup_id string, pos bigint, name string, type string")
    t = spark.createDataFrame([("b", i, n, c) for i, (n, c) in enumerate(types)],
                              "backup_id string, pos bigint, name string, class string")
    return mapping.map_field_types(f, t)


def test_classes(spark):
    for lead in ("solr.", "org.apache.solr.schema.", ""):
        types = [(f"t{i}", lead + c) for i, (c, _) in enumerate(CLASSES)]
        got = mapped(spark, [(f"f{i}", f"t{i}") for i in range(len(CLASSES))], types)
        assert {r["field"]: r["target_type"] for r in got.collect()} == {
            f"f{i}": target for i, (_, target) in enumerate(CLASSES)}


def test_names_beat_classes(spark):
    names = {**rules.TYPE_SHORTCUTS, **{f"text_{x}": "text" for x in ("general", "en", "ws", "", "x")}}
    got = mapped(spark, [(n, n) for n in names], [(n, "solr.BoolField") for n in names])
    assert {r["field"]: r["target_type"] for r in got.collect()} == names
    assert {r["rule"] for r in got.collect()} == {"prefix", "shortcut"}


def test_unknown_falls_back(spark, rows):
    got = mapped(spark, [("a", "nowhere"), ("b", "odd"), ("c", "Text_general"), ("d", "STRING")],
                 [("odd", "com.example.Odd")])
    assert {(r["target_type"], r["rule"]) for r in got.collect()} == {("keyword", "default")}
    assert rows(mapping.unknown_types(got)) == [
        ("STRING", "", 1), ("Text_general", "", 1), ("nowhere", "", 1), ("odd", "com.example.Odd", 1)]


def test_last_declaration_counts(spark, rows):
    got = mapped(spark, [("f", "a"), ("g", "a"), ("f", "pint")],
                 [("a", "solr.BoolField"), ("a", "solr.TextField")])
    assert rows(mapping.final_mapping(got)) == [
        ("b", "f", "integer", "shortcut"), ("b", "g", "text", "class")]


def test_internal_fields(spark, rows):
    fields = spark.createDataFrame(
        [("b", i, n, "string") for i, n in enumerate(["_version_", "_root_", "_text_", "id", "", "a_"])],
        "backup_id string, pos bigint, name string, type string")
    assert rows(mapping.visible_fields(fields), "name") == [("",), ("_text_",), ("a_",), ("id",)]


SCHEMA = """<?xml version="1.0" encoding="UTF-8" ?>
<schema name="x"><types><fieldType name="a" class="solr.StrField"><analyzer><filter class="f"/></analyzer></fieldType>
<fieldType name="noclass"/></types>
<!-- <field name="commented" type="a"/> -->
<fields><field name="one" type="a"/><deep><field name="two &lt; three" type="pint"></field></deep>
<field type="a"/><field name="one" type="pint"/></fields>
<dynamicField name="*_s" type="a"/><copyField source="one" dest="two"/><Field name="upper" type="a"/>
<fieldtype name="lower" class="c"/></schema>"""


def test_schema_document(spark, rows):
    documents = spark.createDataFrame(
        [("b", SCHEMA), ("bad", '<schema><field name="x" type="y"/><open></schema>'),
         ("empty", "<schema/>"), ("nothing", "")], "backup_id string, content string")
    found = schema.schema_declarations(documents)
    assert rows(schema.schema_types(found), "backup_id", "name", "class") == [
        ("b", "a", "solr.StrField"), ("b", "noclass", "")]
    assert [r[1:] for r in rows(schema.schema_fields(found), "backup_id", "pos", "name", "type")] == [
        (2, "one", "a"), (3, "two < three", "pint"), (4, "", "a"), (5, "one", "pint")]
    assert rows(schema.schema_counts(found)) == [
        ("b", 2, 4, 2, 0), ("bad", 0, 0, 0, 1), ("nothing", 0, 0, 0, 1)]


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "UTF-16", "windows-1252", "UTF-8"])
def test_schema_in_its_declared_encoding(spark, rows, encoding):
    text = f'<?xml version="1.0" encoding="{encoding}"?><schema><field name="année" type="b"/></schema>'
    documents = spark.createDataFrame([("b", bytearray(text.encode(encoding)))], "backup_id string, content binary")
    found = schema.schema_declarations(documents)
    assert rows(schema.schema_fields(found), "name", "type") == [("année", "b")]
    unknown = spark.createDataFrame([("b", bytearray(b'<?xml version="1.0" encoding="nonsense"?><schema/>'))],
                                    "backup_id string, content binary")
    assert rows(schema.schema_declarations(unknown), "kind") == [("error",)]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_mapping_document(spark, size):
    fields = [(f'field "{i}"', rules.TARGET_TYPES[i % 10]) for i in range(40)]
    df = spark.createDataFrame([("b", f, t) for f, t in fields] + [("c", "x", "date")],
                               "backup_id string, field string, target_type string")
    parts = mapping.build_mapping(df, size).orderBy("backup_id", "part").collect()
    texts = {b: "".join(p["body"] for p in parts if p["backup_id"] == b) for b in ("b", "c")}
    assert json.loads(texts["b"]) == {"_doc": {"properties": {f: {"type": t} for f, t in fields}}}
    assert json.loads(texts["c"]) == {"_doc": {"properties": {"x": {"type": "date"}}}}


def test_no_fields_no_document(spark):
    df = spark.createDataFrame([], "backup_id string, field string, target_type string")
    assert mapping.build_mapping(df).count() == 0


def test_typed_values(spark):
    df = spark.createDataFrame(
        [("7", "1.5", "2024-06-01T10:00:00Z", "true", "AAE=", "40.5, -73.9"),
         ("x", "y", "z", "maybe", None, "north")],
        "i string, d string, t string, b string, raw string, p string")
    good, bad = mapping.typed_load(df, {"i": "integer", "d": "double", "t": "date", "b": "boolean",
                                        "raw": "binary", "p": "geo_point"}).collect()
    assert (good["i"], good["d"], good["b"], bytes(good["raw"])) == (7, 1.5, True, b"\0\1")
    assert good["t"].isoformat() == "2024-06-01T10:00:00" and tuple(good["p"]) == (40.5, -73.9)
    assert tuple(bad) == (None,) * 6


def test_capabilities(spark, rows):
    df = spark.createDataFrame([("b", "t", "text"), ("b", "k", "keyword"), ("b", "n", "long"),
                                ("b", "g", "geo_point")],
                               "backup_id string, field string, target_type string")
    assert rows(mapping.query_capability(df), "field", "predicate") == [
        ("k", "term"), ("n", "aggregate"), ("n", "range"), ("n", "term"), ("t", "match")]
