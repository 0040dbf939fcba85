"""Field types and fields declared in source schema documents."""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECLARATION = "backup_id string, kind string, pos bigint, name string, value string"
# element -> the attribute kept besides the name
ELEMENTS = {"fieldType": "class", "field": "type"}
IGNORED = ("dynamicField", "copyField")
CHUNK = 1 << 16
BATCH = 5_000


def _declarations(content: bytes | str) -> list[tuple]:
    """(kind, pos, name, value) in document order; one row of kind 'error' and no other where
    the document is not well-formed. Bytes are read in the encoding that they declare."""
    found: list[tuple] = []
    position = 0

    def start(tag, attributes):
        nonlocal position
        if tag in ELEMENTS:
            found.append((tag, position, attributes.get("name", ""),
                          attributes.get(ELEMENTS[tag], "")))
            position += 1
        elif tag in IGNORED:
            found.append(("ignored", position, attributes.get("name", ""), tag))
            position += 1

    # text is decoded already, whatever it declares
    parser = expat.ParserCreate("UTF-8" if isinstance(content, str) else None)
    parser.StartElementHandler = start
    try:
        for at in range(0, len(content), CHUNK):
            parser.Parse(content[at:at + CHUNK], False)
        parser.Parse("" if isinstance(content, str) else b"", True)
    except (expat.ExpatError, LookupError, ValueError) as e:
        return [("error", 0, "", str(e))]
    return found


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [p.split()[0] for p in DECLARATION.split(", ")]
    rows = []
    for batch in batches:
        for backup_id, content in zip(batch["backup_id"], batch["content"]):
            for declaration in _declarations(content or ""):
                rows.append((backup_id, *declaration))
                if len(rows) >= BATCH:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def schema_declarations(documents: DataFrame) -> DataFrame:
    """All declarations of the schema documents (backup_id, content), bytes or text.

    Elements count at any depth and only under their exact tag name; a missing
    attribute is an empty string; ``pos`` follows the document. A document that is
    not well-formed is rejected: it gives a row of kind ``error`` and nothing else."""
    return documents.select("backup_id", "content").mapInPandas(_parse, DECLARATION)


def schema_types(declarations: DataFrame) -> DataFrame:
    return declarations.filter(F.col("kind") == "fieldType").select(
        "backup_id", "pos", "name", F.col("value").alias("class"))


def schema_fields(declarations: DataFrame) -> DataFrame:
    return declarations.filter(F.col("kind") == "field").select(
        "backup_id", "pos", "name", F.col("value").alias("type"))


def schema_counts(declarations: DataFrame) -> DataFrame:
    """Declarations read and ignored in each backup."""
    def of(kind: str):
        return F.count_if(F.col("kind") == kind)

    return declarations.groupBy("backup_id").agg(
        of("fieldType").alias("types"), of("field").alias("fields"),
        of("ignored").alias("ignored_declarations"), of("error").alias("errors"))
