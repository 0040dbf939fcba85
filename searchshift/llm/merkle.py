"""A Merkle manifest of a table, with a proof for every row made by pointer jumping.

Every row is a leaf, the SHA-256 of its columns. The leaves of a language, by document id,
are joined two by two, level by level, into the language's root; the roots of the languages, in their
order, are joined likewise into the root of the table. An odd node at the end is hashed alone.

Trees are built eight levels at a time: 256 neighbours meet in one group, which yields all nodes
above them. Each node starts with one segment, the sibling towards its parent. Then the
table of nodes is joined with itself: a node takes over the segment of the ancestor its own segment
ends at, so segments double with every join until each leaf reaches the root. After a
join over distance d only nodes on levels that 2d divides are still asked for, so what
moves is little more than the leaves. Proofs of the language trees and of the tree of their roots are
made alike and put together by language.

Leaves are numbered by a range sort, so a language of any size is spread over tasks; texts are
read once and never moved. An ancestor that is shared by very many nodes belongs to a level of few
nodes: such a level is sent to all tasks, if it is counted to be small, and joined otherwise. The driver
sees the number of levels and the root.

Defined results: a null column counts as ``-``; rows without id come first, equal ids follow the
order of their leaves; repeated rows are leaves each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .expressions import let
from .ranked import places, with_parents

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one grouping builds, as the power of two that is its width.
STEP = 8
#: Bytes of a level that is sent to every task, at most.
MOST_BYTES = 1 << 20
#: A segment's entry for a node without sibling, and the first byte of one on the left or right.
ALONE, LEFT, RIGHT = "X''", "X'4C'", "X'52'"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(values: dict[str, Column]) -> Column:
    """Hash of a row: each column as ``-`` or byte count, colon and value."""
    fields = []
    for name in COLUMNS:
        value = values[name].cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return _sha(F.concat(*fields))


def leaves(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None) -> DataFrame:
    """(tree, doc_id, leaf, found): the hash of every row as it was, and as it is found later, with
    the columns in ``change`` replaced where ``tampered``; null if not replaced."""
    plain = {name: F.col(name) for name in COLUMNS}
    found = F.lit(None).cast("string")
    if tampered is not None:
        found = F.when(tampered, leaf(plain | change))
    # null before any language, in the order of their bytes
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(plain).alias("leaf"),
                       found.alias("found"))


def _parents(level: Column) -> Column:
    """The hashes above a level, two by two."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")),
                       lambda k: _sha(F.concat(level[2 * k], F.coalesce(F.get(level, 2 * k + 1), F.lit("")))))


def _sibling(level: Column, k: Column) -> Column:
    other = F.get(level, F.when(k % 2 == 0, k + 1).otherwise(k - 1))
    side = F.when(k % 2 == 0, F.expr(RIGHT)).otherwise(F.expr(LEFT))
    return F.coalesce(F.concat(side, F.unhex(other)), F.expr(ALONE))


def grow(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Nodes below the roots, roots (tree, root), and levels of the highest tree, of ``rows`` (tree, place,
    size, h, about). A node (tree, level, place, about, segment) is known by its level and its place there."""
    most = rows.agg(F.max("size")).first()[0] or 0
    height = max(0, (most - 1).bit_length())
    # levels above a level of so many nodes
    above = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    parts, roots, base = [], [], 0
    while base < max(1, height):
        block = rows.groupBy("tree", "size", F.shiftright("place", STEP).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("place", "h", "about"))).alias("row"))
        steps = F.least(F.lit(STEP), above)
        bottom = F.array(F.transform("row", lambda r: r["h"]))
        levels = F.when(steps > 0, F.aggregate(
            F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), bottom,
            lambda done, _: F.concat(done, F.array(let(F.element_at(done, -1), _parents))))).otherwise(bottom)
        built = materialized(block.select("tree", "size", "block", "row", steps.alias("steps"), levels.alias("levels")),
                             f"{label}-levels")
        each = built.where("steps > 0").select(
            "tree", "block", "row", F.posexplode(F.slice("levels", F.lit(1), F.col("steps"))).alias("k", "level"))
        nodes = each.select(
            "tree", "block", "k", F.when(F.col("k") == 0, F.col("row.about")).alias("abouts"),
            F.posexplode(F.transform("level", lambda _, i: _sibling(F.col("level"), i))).alias("i", "sibling"))
        parts.append(nodes.select(
            "tree", (F.col("k") + base).alias("level"),
            (F.expr(f"shiftleft(block, {STEP} - k)") + F.col("i")).alias("place"),
            F.get("abouts", F.col("i")).alias("about"), F.array("sibling").alias("segment")))
        top = F.element_at("levels", -1)
        after = F.col("size") <= 1 << STEP
        roots.append(built.where(after).select("tree", top[0].alias("root"),
                                               F.when(F.col("steps") == 0, F.col("row")[0]["about"]).alias("about")))
        about = rows.schema["about"].dataType
        rows = built.where(~after).select(
            "tree", F.ceil(F.col("size") / (1 << STEP)).alias("size"), F.col("block").alias("place"), top[0].alias("h"),
            F.lit(None).cast(about).alias("about"))
        base += STEP
    nodes, done = parts[0], roots[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    for more in roots[1:]:
        done = done.unionByName(more)
    # a tree of one leaf has no levels, but a proof
    single = done.where("about is not null").select(
        "tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("place"), "about",
        F.array().cast("array<binary>").alias("segment"))
    return nodes.unionByName(single), done.select("tree", "root"), height


def jump(nodes: DataFrame, height: int, label: str) -> DataFrame:
    """(tree, about, segment) of all leaves, their segments reaching to the root."""
    distance = 1
    nodes = materialized(nodes, label)
    while distance < height:
        asked = F.col("level") % (2 * distance)
        low = nodes.where(asked == 0).withColumn("_up", F.shiftright("place", distance))
        high = nodes.where(asked == distance).select(
            "tree", (F.col("level") - distance).alias("level"), F.col("place").alias("_up"), F.col("segment").alias("_more"))
        if high.count() * (33 * distance + 64) <= MOST_BYTES:
            high = F.broadcast(high)
        # where the segment ends at the root there is nothing to take over
        joined = low.join(high, ["tree", "level", "_up"], "left").select(
            "tree", "level", "place", "about",
            F.concat("segment", F.coalesce("_more", F.array().cast("array<binary>"))).alias("segment"))
        nodes = materialized(joined, label)
        distance *= 2
    return nodes.where("level = 0").select("tree", "about", "segment")


def _hex(entry: Column) -> Column:
    return F.lower(F.hex(F.substring(entry, 2, 32)))


def fold(start: Column, segment: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    step = lambda h, s: _sha(F.when(F.length(s) == 0, h)
                             .when(F.substring(s, 1, 1) == F.expr(LEFT), F.concat(_hex(s), h))
                             .otherwise(F.concat(h, _hex(s))))
    return F.aggregate(segment, start, step)


def proofs(rows: DataFrame) -> DataFrame:
    """(doc_id, leaf, found, subroot, root, segment) of all ``leaves``."""
    placed = places(materialized(rows, "leaves"), "tree", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "leaf-places")
    placed = placed.select("tree", "place", "size", F.col("leaf").alias("h"), F.struct("doc_id", "leaf", "found").alias("about"))
    nodes, subroots, height = grow(placed, "tree")
    below = jump(nodes, height, "proofs")
    subroots = materialized(subroots, "subroots")
    tops = places(subroots.withColumn("top", F.lit("")), "top", [F.col("tree")], "subroot-places")
    tops = tops.select(F.col("top").alias("tree"), "place", "size", F.col("root").alias("h"),
                       F.struct("tree", F.col("root").alias("subroot")).alias("about"))
    top_nodes, root, top_height = grow(tops, "top")
    above = jump(top_nodes, top_height, "top-proofs").join(F.broadcast(root), "tree").select(
        F.col("about.tree").alias("tree"), F.col("about.subroot").alias("subroot"), "root", F.col("segment").alias("rest"))
    joined = with_parents(below, materialized(above, "top-proofs"), ["tree"], ["about"])
    return joined.select("about.*", "subroot", "root", F.concat("segment", "rest").alias("segment"))


def manifest(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``."""
    proved = proofs(leaves(docs, tampered, change))
    siblings = F.transform(F.filter("segment", lambda s: F.length(s) > 0), _hex)
    return proved.select(
        "doc_id", "leaf", "subroot", "root", _sha(F.array_join(siblings, "")).alias("proof_sha256"),
        fold(F.coalesce("found", "leaf"), F.col("segment")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


#: The same rows in SQL, walking each leaf's path.
ORACLE = """
WITH RECURSIVE cells AS (
  SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS more,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
        lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 7 = 0 AS tampered
  FROM cells),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes(lang, k, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT lang, k + 1, i // 2, (n + 1) // 2, h FROM (
    SELECT lang, k, i - i % 2 AS i, any_value(n) AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM nodes WHERE n > 1 GROUP BY lang, k, i - i % 2)),
subs AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(k, i, n, h) AS (
  SELECT 0, i, n, h FROM subs
  UNION ALL
  SELECT k + 1, i // 2, (n + 1) // 2, h FROM (
    SELECT k, i - i % 2 AS i, any_value(n) AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM tops WHERE n > 1 GROUP BY k, i - i % 2)),
low AS (
  SELECT p.doc_id, p.lang, p.leaf, coalesce(string_agg(s.h, '' ORDER BY s.k), '') AS proof,
    list(struct_pack(h := s.h, left_side := (p.i >> s.k) % 2 = 1, k := s.k) ORDER BY s.k) FILTER (s.h IS NOT NULL) AS steps,
    any_value(p.n) AS n, CASE WHEN any_value(p.tampered) THEN any_value(p.more) ELSE p.leaf END AS seen, p.i
  FROM placed p LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.n > 1 AND s.i = xor(p.i >> s.k, 1)
  GROUP BY p.doc_id, p.lang, p.leaf, p.i),
high AS (
  SELECT u.lang, u.h AS subroot, coalesce(string_agg(s.h, '' ORDER BY s.k), '') AS proof,
    list(struct_pack(h := s.h, left_side := (u.i >> s.k) % 2 = 1, k := s.k) ORDER BY s.k) FILTER (s.h IS NOT NULL) AS steps,
    any_value(u.n) AS n
  FROM subs u LEFT JOIN tops s ON s.n > 1 AND s.i = xor(u.i >> s.k, 1) GROUP BY u.lang, u.h, u.i),
walk(doc_id, lang, i, k, levels, steps, h) AS (
  SELECT doc_id, lang, i, 0, CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END, coalesce(steps, []), seen FROM low
  UNION ALL
  SELECT doc_id, lang, i, k + 1, levels, steps, CASE
    WHEN len(list_filter(steps, lambda s: s.k = w.k)) = 0 THEN sha256(h)
    WHEN list_filter(steps, lambda s: s.k = w.k)[1].left_side THEN sha256(list_filter(steps, lambda s: s.k = w.k)[1].h || h)
    ELSE sha256(h || list_filter(steps, lambda s: s.k = w.k)[1].h) END
  FROM walk w WHERE k < levels),
climb(doc_id, lang, i, k, levels, steps, h) AS (
  SELECT w.doc_id, w.lang, w.i, 0, CASE WHEN g.n > 1 THEN length(bin(g.n - 1)) ELSE 0 END, coalesce(g.steps, []), w.h
  FROM walk w JOIN high g ON g.lang IS NOT DISTINCT FROM w.lang WHERE w.k = w.levels
  UNION ALL
  SELECT doc_id, lang, i, k + 1, levels, steps, CASE
    WHEN len(list_filter(steps, lambda s: s.k = w.k)) = 0 THEN sha256(h)
    WHEN list_filter(steps, lambda s: s.k = w.k)[1].left_side THEN sha256(list_filter(steps, lambda s: s.k = w.k)[1].h || h)
    ELSE sha256(h || list_filter(steps, lambda s: s.k = w.k)[1].h) END
  FROM climb w WHERE k < levels)
SELECT l.doc_id, l.leaf, g.subroot, t.h AS root, sha256(l.proof || g.proof) AS proof_sha256, c.h AS folded_root,
  c.h = t.h AS verified
FROM low l JOIN high g ON g.lang IS NOT DISTINCT FROM l.lang
JOIN climb c ON c.lang IS NOT DISTINCT FROM l.lang AND c.i = l.i AND c.k = c.levels
JOIN tops t ON t.n = 1"""
