"""Exact duplicates by owners in Patricia tries.

Texts are equal when they are equal with every run of blanks replaced by one space. A trie
holds whole byte strings with paths compressed to slices of the strings that made them; the
node where a string ends keeps the smallest row that has it and the number of rows.

1. Every task inserts its rows into a trie of its own and writes down, for each row, the number of
   the node it ended at, and for each node its string, smallest row and count. So copies are
   counted before anything moves, and a group that holds a third of all rows is one string per task.
2. Strings that a task has seen more than once may be anywhere in great numbers: they are dealt
   out by length, content hash and one of 64 salts, and merged there.
3. Strings are dealt out by length and content hash, so equal ones meet, and are inserted again. A node
   answers for all strings that ended there.

A trie holds a bounded number of bytes. When it is full the heaviest subtree spills: its
nodes go out as strings to be inserted in a further round, in which they are dealt to more places. At the end
the rest of a region that has spilled goes the same way, so no string has two owners. Rounds go on
until nothing spills; a string too long for the bound stands alone. Every round is a written table, and
nothing is kept on the machine that made it.

Defined results: a null text is an empty one; of rows with the same least id in a group, the first
as read stays; rows without id stay only if their group has no id; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .tokens import slices

#: Bytes of text that a trie holds, and bytes of text per place that strings are dealt to.
TRIE_BYTES, PLACE_BYTES = 32 << 20, 16 << 20
SALTS = 64
#: How many times more places a further round has.
GROWTH = 8

#: Rows of documents (doc_id, at, ref), of nodes (ref, length, ..., spilled) and of strings that
#: ended at the node of another (came, ref).
ROWS = ("doc_id long, at long, came long, ref long, length long, hash binary, packed binary, no_id int, least long, "
        "row long, n long, sha256 binary, spilled boolean")
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


class Node:
    """A place in the trie: its label is ``text[start:end]``; a terminal has ``owner``."""
    __slots__ = ("text", "start", "end", "children", "owner")

    def __init__(self, text: bytes, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.children: dict[int, Node] = {}
        self.owner: list | None = None


def _agree(a: bytes, i: int, b: bytes, j: int, most: int) -> int:
    """Bytes that a[i:] and b[j:] have in common at their start, at most ``most``."""
    if a[i:i + most] == b[j:j + most]:
        return most
    low, step = 0, 16
    while a[i + low:i + low + step] == b[j + low:j + low + step]:
        low += step
        step *= 2
    high = min(low + step, most)  # they differ before
    while high - low > 1:
        middle = (low + high) // 2
        if a[i + low:i + middle] == b[j + low:j + middle]:
            low = middle
        else:
            high = middle
    return low


class Trie:
    """Byte strings with their owners: [number, least row as (no id, id, row), count]."""

    def __init__(self, most_bytes: int = TRIE_BYTES):
        self.root, self.most, self.bytes = Node(b"", 0, 0), most_bytes, 0
        #: First bytes whose subtrees have spilled.
        self.spilled: set[int] = set()

    def insert(self, text: bytes, number: int, least: tuple, n: int) -> int:
        """The number of the node where ``text`` ends, its own where it is new."""
        node, at, size = self.root, 0, len(text)
        while at < size:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text, at, size)
                node = child
                break
            label = child.end - child.start
            same = _agree(child.text, child.start, text, at, min(label, size - at))
            if same < label:
                upper = Node(child.text, child.start, child.start + same)
                child.start += same
                upper.children[child.text[child.start]] = child
                node.children[text[at]] = upper
                child = upper
            node, at = child, at + same
        if node.owner is None:
            node.owner = [number, least, n, text]
            self.bytes += size
        else:
            node.owner[1] = min(node.owner[1], least)
            node.owner[2] += n
        return node.owner[0]

    @property
    def full(self) -> bool:
        return self.bytes > self.most

    @staticmethod
    def owners(node: Node) -> Iterator[list]:
        stack = [node]
        while stack:
            node = stack.pop()
            if node.owner is not None:
                yield node.owner
            stack.extend(node.children.values())

    def spill(self) -> list[list]:
        """Owners of the heaviest subtree, which is cut off; nothing if it is a single string."""
        heaviest, most = None, -1
        for first, child in self.root.children.items():
            weight = sum(len(o[3]) for o in self.owners(child))
            if weight > most:
                heaviest, most = first, weight
        out = list(self.owners(self.root.children[heaviest]))
        if len(out) < 2:
            self.most = max(self.most, 2 * self.bytes)
            return []
        del self.root.children[heaviest]
        self.bytes -= most
        self.spilled.add(heaviest)
        return out

    def rest(self) -> Iterator[tuple[list, bool]]:
        """All owners left, and whether their region has spilled."""
        if self.root.owner is not None:
            yield self.root.owner, False
        for first, child in self.root.children.items():
            for owner in self.owners(child):
                yield owner, first in self.spilled


def normal(text: bytes) -> bytes:
    """Every run of blanks as one space, at the ends too."""
    words = text.split()
    if not words:
        return b" " if text else b""
    out = b" ".join(words)
    return (b" " if text[:1].isspace() else b"") + out + (b" " if text[-1:].isspace() else b"")


def _batch(count: int, /, **columns: list | np.ndarray) -> pa.RecordBatch:
    """Rows of the common form; columns that are not given are null."""
    fields = [f.split() for f in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], _KINDS[kind]) if name in columns else pa.nulls(count, _KINDS[kind]) for name, kind in fields],
        names=[name for name, _ in fields])


def _nodes(owners: Iterator[tuple[list, bool]], texts: bool = True) -> Iterator[pa.RecordBatch]:
    """Owners, and whether they have spilled, as rows; a few megabytes of text at a time.
    Without ``texts`` only those that have spilled keep their string."""
    squeeze = zstandard.ZstdCompressor(3).compress
    owners, more = iter(owners), True
    while more:
        part, size, more = [], 0, False
        for owner in owners:
            part.append(owner)
            size += len(owner[0][3])
            if size > 4 << 20 or len(part) == 10_000:
                more = True
                break
        strings = [o[3] for o, _ in part]
        yield _batch(
            len(part), ref=[o[0] for o, _ in part], length=[len(t) for t in strings],
            hash=[xxhash.xxh3_128_digest(t) for t in strings],
            packed=[squeeze(t) if texts or s else None for t, (_, s) in zip(strings, part)],
            no_id=[o[1][0] for o, _ in part], least=[None if o[1][0] else o[1][1] for o, _ in part],
            row=[o[1][2] for o, _ in part], n=[o[2] for o, _ in part],
            sha256=[hashlib.sha256(t).digest() for t in strings], spilled=[s for _, s in part])


def _local(most_bytes: int):
    """The node that each row of a task ended at, and the nodes."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, row = Trie(most_bytes), TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, n in slices(batch["text"]):
                ids = batch["doc_id"].slice(at, n).cast(pa.int64()).to_pylist()
                refs, first = [], row
                for doc_id, text in zip(ids, batch["text"].slice(at, n).cast(pa.large_binary()).to_pylist()):
                    least = (1, 0, row) if doc_id is None else (0, doc_id, row)
                    refs.append(trie.insert(normal(text or b""), row, least, 1))
                    row += 1
                    while trie.full:
                        yield from _nodes((o, True) for o in trie.spill())
                yield _batch(n, doc_id=ids, at=np.arange(first, row), ref=refs)
        yield from _nodes((o, True) for o, _ in trie.rest())
    return job


def _merge(most_bytes: int, last: bool, texts: bool):
    """The nodes of a place, and where the strings ended that met another. In the ``last`` step of
    a string its node is final, unless it has spilled."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, stretch = Trie(most_bytes), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            came, ended = [], []
            columns = [batch[c].to_pylist() for c in ("ref", "no_id", "least", "row", "n")]
            for ref, no_id, least, row, n, packed in zip(*columns, batch["packed"]):
                found = trie.insert(stretch(packed.as_py()), ref, (no_id, least or 0, row), n)
                if found != ref:
                    came.append(ref)
                    ended.append(found)
                while trie.full:
                    yield from _nodes((o, True) for o in trie.spill())
            yield _batch(len(came), came=came, ref=ended)
        yield from _nodes(((o, s or not last) for o, s in trie.rest()), texts)
    return job


def _bytes(nodes: DataFrame) -> int:
    return nodes.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _owners(docs: DataFrame, trie_bytes: int, texts: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, at, ref), final nodes, and the node (ref, final) of every string."""
    spark = docs.sparkSession
    local = materialized(docs.select("doc_id", "text").mapInArrow(_local(trie_bytes), ROWS), "tries")
    nodes = local.where("length is not null")
    least_places = 2 * spark.sparkContext.defaultParallelism
    places = max(least_places, _bytes(nodes) // PLACE_BYTES)
    salt = F.pmod(F.xxhash64("ref"), F.lit(SALTS))
    salted = materialized(
        nodes.where("n > 1").repartition(places, "length", "hash", salt).mapInArrow(_merge(trie_bytes, False, True), ROWS),
        "salted-tries")
    moves, final = [salted.where("came is not null")], []
    spilled = nodes.where("n = 1").unionByName(salted.where("length is not null"))
    while True:
        merged = materialized(spilled.repartition(places, "length", "hash").mapInArrow(
            _merge(trie_bytes, True, texts), ROWS), "merged-tries")
        moves.append(merged.where("came is not null"))
        final.append(merged.where("not spilled"))
        spilled = merged.where("spilled")
        if spilled.isEmpty():
            break
        places *= GROWTH
    ends = final[0]
    for more in final[1:]:
        ends = ends.unionByName(more)
    ways = ends.select("ref", F.col("ref").alias("final"))
    for move in reversed(moves):
        ways = ways.unionByName(move.select("came", "ref").join(ways, "ref").select(F.col("came").alias("ref"), "final"))
    return local.where("at is not null").select("doc_id", "at", "ref"), ends, ways


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text)."""
    rows, ends, ways = _owners(docs, trie_bytes, False)
    known = ways.join(ends.select(F.col("ref").alias("final"), "least", "row", "n", "sha256"), "final").drop("final")
    return rows.join(known, "ref").select(
        "doc_id", F.col("least").alias("keep_id"), F.col("n").alias("group_size"), (F.col("at") == F.col("row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"))


def distinct_texts(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(doc_id, group_size, text): one row for every different text, normalised, with its least id."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at, n in slices(batch["packed"], 1 << 20):
                part = batch.slice(at, n)
                texts = [stretch(p).decode() for p in part["packed"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["least"], part["n"], pa.array(texts, pa.string())],
                                                 names=["doc_id", "group_size", "text"])
    _, ends, _ = _owners(docs, trie_bytes, True)
    return ends.select("least", "n", "packed").mapInArrow(unpack, "doc_id long, group_size long, text string")


#: The same rows in SQL.
ORACLE = """
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM plain"""
