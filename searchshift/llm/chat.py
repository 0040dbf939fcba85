"""Dialogues seen from every participant.

For each speaker of a conversation the whole dialogue is rendered once with that speaker
as the assistant; the others are users who go by their own names, and system turns
are shared context. The mask marks the characters to learn: the assistant's texts and
their closing marks.

A conversation may be arbitrarily long and hold a third of all rows, so a rendering
comes in parts, one per ``part_turns`` consecutive turn numbers; joined in order of ``part`` the
parts are the whole text. No step gathers a whole conversation: its speakers are an
aggregation with few values, and turns meet only the turns of their own part.

Defined results: rows without conversation id or without text have no place in a dialogue
and are left out; a null role counts as '' and is a speaker like any other; a null turn
goes to a last part, -1; turns with the same number are ordered by role, then text,
and repeated rows are rendered as often as they occur; a conversation with only
system turns has no speaker and no rendering; empty texts are rendered as empty turns. Columns
other than the four named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
OPEN, NAMED, BODY, CLOSE = "<|", " name=", "|>\n", "<|end|>\n"
PART_TURNS = 64


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, salts: int = 16) -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_target, text, spans) for every speaker and part.

    ``spans`` are the learned ranges of ``text``, as (start, length) in characters;
    ``n_target`` is their total length."""
    said = turns.where(F.col("conv_id").isNotNull() & F.col("text").isNotNull()).select(
        "conv_id", F.coalesce("role", F.lit("")).alias("role"), "turn", "text",
        F.coalesce(F.floor(F.col("turn") / part_turns).cast("long"), F.lit(-1).cast("long")).alias("part"))
    speakers = said.where(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("speaker")).distinct()
    # one bounded list per part of a conversation
    parts = said.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    # parts of a hot conversation are dealt out; its speakers are in every place
    salt = F.pmod(F.col("part"), F.lit(salts)).cast("int")
    copies = speakers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    seen = parts.withColumn("salt", salt).join(copies, ["conv_id", "salt"]).drop("salt")

    def piece(t: Column) -> Column:
        target = t["role"] == F.col("speaker")
        opening = F.concat(
            F.lit(OPEN),
            F.when(target, F.lit("assistant")).when(t["role"] == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user" + NAMED), t["role"])), F.lit(BODY))
        return F.struct(target.alias("target"), opening.alias("opening"),
                        F.concat(t["text"], F.lit(CLOSE)).alias("body"))

    pieces = seen.withColumn("pieces", F.transform("said", piece))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def walk(acc: Column, p: Column) -> Column:
        body_at = acc["at"] + F.length(p["opening"])
        return F.struct(
            (body_at + F.length(p["body"])).alias("at"),
            F.when(p["target"], F.concat(acc["spans"], F.array(
                F.struct(body_at.alias("start"), F.length(p["body"]).alias("length")))))
            .otherwise(acc["spans"]).alias("spans"))

    return pieces.select(
        "conv_id", "speaker", "part", F.size("said").cast("long").alias("n_turns"),
        F.aggregate("pieces", F.lit(0).cast("long"),
                    lambda acc, p: acc + F.when(p["target"], F.length(p["body"])).otherwise(0)).alias("n_target"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["opening"], p["body"])), "").alias("text"),
        F.aggregate("pieces", start, walk, lambda acc: acc["spans"]).alias("spans"))


#: The same rows in SQL.
ORACLE = """
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, turn, text, coalesce(CAST(floor(turn / 64.0) AS BIGINT), -1) AS part
  FROM conversations WHERE conv_id IS NOT NULL AND text IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
turns AS (
  SELECT s.conv_id, k.speaker, s.part, s.turn, s.role, s.text, s.role = k.speaker AS target,
    '<|' || CASE WHEN s.role = k.speaker THEN 'assistant' WHEN s.role = 'system' THEN 'system'
            ELSE 'user name=' || s.role END || '|>' || chr(10) AS opening,
    s.text || '<|end|>' || chr(10) AS body
  FROM said s JOIN speakers k USING (conv_id)),
placed AS (
  SELECT *, sum(length(opening) + length(body)) OVER w - length(body) AS pos FROM turns
  WINDOW w AS (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, text
               ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, part, count(*) AS n_turns,
  CAST(coalesce(sum(length(body)) FILTER (target), 0) AS BIGINT) AS n_target,
  string_agg(opening || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
  coalesce(string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR) || '+' || CAST(length(body) AS VARCHAR), ' '
    ORDER BY turn NULLS FIRST, role, text) FILTER (target), '') AS spans
FROM placed GROUP BY 1, 2, 3"""
