"""Encoding and decoding where text that documents share is encoded once.

Texts are cut into chunks where a rolling hash of the last 32 bytes says so, so equal passages
are cut alike wherever they stand. Chunks are counted over the whole corpus by a 128-bit
digest. A chunk that several documents share is encoded by one of them, from its first
blank to its last, and the ids are sent to the others; the rest of each document is
encoded where it is. A join is repaired by encoding anew what lies between two pieces, the
words that the cuts broke included, together with the last word of the piece before and
the first of the piece after. If the new ids begin and end with those that the pieces have
there, the join is exact; if not, the text is tried again with twice as many words of each
piece, and pieces too short for that are encoded anew, down to the whole text.

Texts are moved once, compressed, to the place where their documents' ids are put together; the
count moves 24 bytes a chunk. A chunk that a third of all documents share is one row
before it is joined, and that join can be split. Rows equal in id and text are one row with a
number from there on: tasks add them up before they move them, and only results are repeated.

Defined results: a null text is an empty one and has no ids; repeated rows are encoded
once and give a row each; rows that share an id but not the text are kept apart by a digest of both; a text without
blanks is one stretch and goes through the library whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import slices, tokens_of

#: Bytes that a cut depends on, and a chunk's mean length in bytes as a power of two.
LOOK_BACK, MEAN_BITS = 32, 9
#: Shorter chunks are not worth a row.
LEAST = 64
#: Compressed texts that a task holds to find rows that repeat, and what a row costs besides.
HELD_BYTES, ROW_BYTES = 8 << 20, 250
#: Bytes of texts that are worked on at once, and of compressed ones: arrays of their bytes take many times as much,
#: and workers keep what they once took.
SLICE, PACKED_SLICE = 1 << 20, 1 << 19
#: A 32-bit number for each byte value, from a digest, so that all workers cut alike.
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], dtype=np.uint32)
_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True

Finish = Callable[[pa.Array, np.ndarray, np.ndarray], pa.RecordBatch]


class Chunked:
    """Chunks of a run of texts, as positions in their joined bytes."""

    def __init__(self, texts: list[bytes]):
        self.joined = b"".join(texts)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        data = np.frombuffer(self.joined, np.uint8)
        rolled, reach = _GEAR[data], 1
        while reach < LOOK_BACK:  # sums over 2, 4, ... bytes, older ones shifted further
            rolled[reach:] = rolled[reach:] + (rolled[:-reach] << np.uint32(reach))
            reach *= 2
        here = (rolled >> np.uint32(32 - MEAN_BITS)) == 0
        here[1:] &= ~here[:-1].copy()
        cuts = np.flatnonzero(here) + 1
        text_of = np.searchsorted(self.bounds, cuts, "right") - 1
        cuts = cuts[cuts - self.bounds[text_of] >= LOOK_BACK]
        cuts = np.union1d(cuts, self.bounds)
        first, last = cuts[:-1], cuts[1:]
        long = last - first >= LEAST
        first, last = first[long], last[long]
        blanks = np.flatnonzero(_BLANKS[data])
        a, b = np.searchsorted(blanks, first), np.searchsorted(blanks, last) - 1
        whole = b > a  # with a word between two blanks
        #: of each chunk worth sharing: first, last byte; numbers of its first and last blank; its text
        self.first, self.last, self.blanks = first[whole], last[whole], blanks
        self.inner = a[whole], b[whole]
        self.text_of = np.searchsorted(self.bounds, self.first, "right") - 1
        view = memoryview(self.joined)
        digests = b"".join(xxhash.xxh3_128_digest(view[i:j])
                           for i, j in zip(self.first.tolist(), self.last.tolist()))
        self.digests = np.frombuffer(digests, "<i8").reshape(-1, 2)

    def text(self, a: int, b: int) -> str:
        return self.joined[a:b].decode()


def _utf8(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each text, each once per text."""
    for batch in batches:
        for at, n in slices(batch["text"], SLICE):
            chunks = Chunked(_utf8(batch["text"].slice(at, n)))
            keys = batch["key"].slice(at, n).to_numpy()[chunks.text_of]
            rows = np.unique(np.column_stack([keys, chunks.digests]), axis=0) if len(keys) else np.zeros((0, 3), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, k], pa.int64()) for k in range(3)],
                                             names=["key", "h1", "h2"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts; rows equal in id and text are added up as long as they are held."""
    squeeze = zstandard.ZstdCompressor(3).compress
    held: dict[tuple, int] = {}
    size = 0

    def rows() -> pa.RecordBatch:
        keys, ids, packed = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(packed, pa.binary()),
             pa.array(held.values(), pa.int64())], names=["key", "doc_id", "packed", "n"])

    for batch in batches:
        for at, n in slices(batch["text"], SLICE):
            part = batch.slice(at, n)
            for key, doc_id, text in zip(part["key"].to_pylist(), part["doc_id"].to_pylist(), _utf8(part["text"])):
                row = key, doc_id, squeeze(text)
                size += 0 if row in held else len(row[2]) + ROW_BYTES
                held[row] = held.get(row, 0) + 1
                if size > HELD_BYTES:
                    yield rows()
                    held, size = {}, 0
    if held:
        yield rows()


def _unpacked(batch: pa.RecordBatch, most_bytes: int = PACKED_SLICE) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, rows, texts) by runs of rows whose compressed texts are bounded."""
    stretch = zstandard.ZstdDecompressor().decompress
    for at, n in slices(batch["packed"], most_bytes):
        yield at, n, [stretch(t) for t in batch["packed"].slice(at, n).to_pylist()]


def _share(tokenizer: str):
    """Ids of the chunks that a document was chosen to encode."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            for at, n, texts in _unpacked(batch):
                chunks = Chunked(texts)
                wanted = [{(h["h1"], h["h2"]) for h in row} for row in batch["owned"].slice(at, n).to_pylist()]
                mine = []
                for k, (text, h) in enumerate(zip(chunks.text_of.tolist(), map(tuple, chunks.digests.tolist()))):
                    if h in wanted[text]:
                        wanted[text].discard(h)
                        mine.append(k)
                a, b = (chunks.blanks[chunks.inner[0][mine]].tolist(), (chunks.blanks[chunks.inner[1][mine]] + 1).tolist())
                ids, bounds = tokens.encode(pa.array([chunks.text(i, j) for i, j in zip(a, b)], pa.string()))
                cells = [ids[i:j].astype("<u4").tobytes() if tokens.wide else ids[i:j].astype("<u2").tobytes()
                         for i, j in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunks.digests[mine, 0], pa.int64()), pa.array(chunks.digests[mine, 1], pa.int64()),
                     pa.array(cells, pa.binary())], names=["h1", "h2", "ids"])
    return job


def joined(chunks: Chunked, text: int, pieces: list[tuple[int, int, np.ndarray]], reach: int) -> tuple[list, list]:
    """What to encode for one text: the stretches around its pieces, and the overlaps of
    both kinds (the last ``reach`` words of the piece before, the first of the one after)."""
    blanks, here = chunks.blanks, int(chunks.bounds[text])
    stretches, overlaps = [], []
    for a, b, _ in pieces:
        head, tail = int(blanks[a + reach]) + 1, int(blanks[b - reach])
        stretches.append(chunks.text(here, head))
        overlaps += [chunks.text(int(blanks[a]), head), chunks.text(tail, int(blanks[b]) + 1)]
        here = tail
    stretches.append(chunks.text(here, int(chunks.bounds[text + 1])))
    return stretches, overlaps


def agreed(stretches: list[np.ndarray], overlaps: list[int], pieces: list[tuple[int, int, np.ndarray]]) -> list | None:
    """The parts of a text's ids in order, or None if a stretch and a piece differ where they overlap."""
    parts, skip = [], 0
    for k, (_, _, ids) in enumerate(pieces):
        before, after = stretches[k], stretches[k + 1]
        head, tail = overlaps[2 * k], overlaps[2 * k + 1]
        if not (0 < head <= len(before) - skip and 0 < tail <= len(after) and head + tail <= len(ids)
                and np.array_equal(before[len(before) - head:], ids[:head])
                and np.array_equal(after[:tail], ids[len(ids) - tail:])):
            return None
        parts += [before[skip:len(before) - head], ids]
        skip = tail
    return parts + [stretches[-1][skip:]]


def _ids_of_texts(tokens, chunks: Chunked, reused: list[list]) -> list[list]:
    """For each text the parts of its ids, from its pieces (first blank, last blank, ids)."""
    done: list[list | None] = [None] * len(reused)
    todo, reach = list(range(len(reused))), 1
    while todo:
        usable = [[p for p in reused[t] if p[1] - p[0] > 2 * reach] for t in todo]
        work = [joined(chunks, t, pieces, reach) for t, pieces in zip(todo, usable)]
        ids, bounds = tokens.encode(pa.array([x for stretches, _ in work for x in stretches], pa.string()))
        _, ends = tokens.encode(pa.array([x for _, overlaps in work for x in overlaps], pa.string()))
        lengths = np.diff(ends).tolist()
        at, over, left = 0, 0, []
        for t, pieces in zip(todo, usable):
            stretches = [ids[bounds[k]:bounds[k + 1]] for k in range(at, at + len(pieces) + 1)]
            done[t] = agreed(stretches, lengths[over:over + 2 * len(pieces)], pieces)
            at, over = at + len(pieces) + 1, over + 2 * len(pieces)
            if done[t] is None:
                left.append(t)
        todo, reach = left, 2 * reach
    return done


def _repeated(rows: pa.RecordBatch, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each row so many times, in batches of bounded size."""
    if (times == 1).all():
        yield rows
        return
    most = max(1, HELD_BYTES * len(rows) // max(1, rows.nbytes))
    ends = np.cumsum(times)
    for start in range(0, int(ends[-1]), most):
        wanted = np.arange(start, min(start + most, int(ends[-1])))
        yield rows.take(pa.array(np.searchsorted(ends, wanted, "right")))


def _join(tokenizer: str, finish: Finish):
    """Ids of whole documents from the pieces they got and what is between."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        kind = "<u4" if tokens.wide else "<u2"
        for batch in batches:
            for at, n, texts in _unpacked(batch):
                chunks = Chunked(texts)
                given = [{(p["h1"], p["h2"]): p["ids"] for p in row or ()}
                         for row in batch["pieces"].slice(at, n).to_pylist()]
                reused: list[list] = [[] for _ in texts]
                for text, h, a, b in zip(chunks.text_of.tolist(), map(tuple, chunks.digests.tolist()),
                                         chunks.inner[0].tolist(), chunks.inner[1].tolist()):
                    if given[text] and h in given[text]:
                        reused[text].append((a, b, np.frombuffer(given[text][h], kind)))
                parts = _ids_of_texts(tokens, chunks, reused)
                lengths = np.array([sum(map(len, p)) for p in parts], dtype=np.int64)
                ids = np.concatenate([x for p in parts for x in p]).astype(np.uint32)
                rows = finish(batch["doc_id"].slice(at, n), ids, np.concatenate([[0], np.cumsum(lengths)]))
                yield from _repeated(rows, batch["n"].slice(at, n).to_numpy())
    return job


def ids_of(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """The ids themselves, as (doc_id, ids)."""
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), lists], names=["doc_id", "ids"])


def digests_of(tokenizer: str) -> Finish:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the text is decoded from the ids."""
    def finish(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        tokens = tokens_of(tokenizer)
        number, word = tokens.numbers, tokens.words
        shas, decoded = [], []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            own = ids[a:b].tolist()
            shas.append(hashlib.sha256(b" ".join([number[i] for i in own])).hexdigest())
            decoded.append(hashlib.sha256(b" ".join([word[i] for i in own])).hexdigest())
        return pa.RecordBatch.from_arrays(
            [doc_ids.cast(pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(shas, pa.string()),
             pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return finish


def encode(docs: DataFrame, tokenizer: str, finish: Finish = ids_of,
           schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), made by ``finish`` from its ids."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    occurrences = keyed.select("key", "text").mapInArrow(_occurrences, "key long not null, h1 long not null, h2 long not null")
    shared = (occurrences.groupBy("h1", "h2").agg(F.min("key").alias("key"), F.max("key").alias("other"))
              .where("key < other").select("key", "h1", "h2"))
    owned = shared.groupBy("key").agg(F.collect_list(F.struct("h1", "h2")).alias("owned"))
    # moved once and read by both joins, which must ask for the same columns; equal rows meet here,
    # after they were added up by task
    packed = (keyed.mapInArrow(_pack, "key long not null, doc_id long, packed binary, n long not null").repartition("key")
              .groupBy("key", "doc_id", "packed").agg(F.sum("n").alias("n")))
    encoded = (packed.join(owned, "key").select("key", "doc_id", "packed", "n", "owned")
               .mapInArrow(_share(tokenizer), "h1 long not null, h2 long not null, ids binary"))
    pieces = (occurrences.distinct().join(encoded, ["h1", "h2"]).groupBy("key")
              .agg(F.collect_list(F.struct("h1", "h2", "ids")).alias("pieces")))
    return (packed.join(pieces, "key", "left").select("key", "doc_id", "packed", "n", "pieces")
            .mapInArrow(_join(tokenizer, finish), schema))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    return encode(docs, tokenizer, digests_of(tokenizer),
                  "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
