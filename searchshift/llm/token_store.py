"""Token ids of a corpus as a table of Simple-8b pages in document order.

Documents are dealt out by ranges of their id and sorted, so file after file holds
them in ascending order. Each row of a file is a page of whole documents: the coded words, the
word offset of every block, the escaped values, and per document its id and number of
token ids. Any page, and any block of a page, is read without the ones before it; where
a page begins among the ids of its file is written with it, and the totals of the files
give the rest.

Tables go through Spark's own writer, so they may lie on any file system, and a task that
runs again leaves no second copy. Texts are moved once; each task holds a few megabytes
of text at a time, or one document.

Defined results: a null text is an empty one and yields the end id alone; null document
ids come first, repeated ids side by side, ordered by a hash of their texts; an empty table
gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .tokens import slices, tokens_of

PAGES = ("shard int, first long, n_ids long, words binary, offsets binary, escaped binary, "
         "doc_ids array<bigint>, lengths array<bigint>")
DIGESTS = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"


def _page(first: int, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    words, offsets, escaped = simple8b.encode(ids)
    shard = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([
        pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
        pa.array([words.astype("<u8").tobytes()], pa.binary()),
        pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
        pa.array([escaped.astype("<u8").tobytes()], pa.binary()),
        pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int64()))],
        names=["shard", "first", "n_ids", "words", "offsets", "escaped", "doc_ids", "lengths"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the pages."""
    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, first = tokens_of(tokenizer), 0
        for batch in batches:
            for at, n in slices(batch["text"]):
                ids, bounds = tokens.encode(batch["text"].slice(at, n))
                lengths = np.diff(bounds) + 1
                ids = np.insert(ids, bounds[1:], end_id)
                yield _page(first, batch["doc_id"].slice(at, n).cast(pa.int64()), ids, lengths)
                first += len(ids)

    ordered = (docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_tie").drop("_tie"))
    ordered.mapInArrow(pages, PAGES).write.option("compression", "none").parquet(path)


def read_ids(page: dict) -> np.ndarray:
    """All ids of one page."""
    return simple8b.decode(np.frombuffer(page["words"], "<u8"), np.frombuffer(page["escaped"], "<u8"))


def read_block(page: dict, block: int) -> np.ndarray:
    """The ids of one block of a page, from its own words alone."""
    offsets = np.frombuffer(page["offsets"], "<u4").tolist() + [len(page["words"]) // 8]
    words = np.frombuffer(page["words"], "<u8")[offsets[block]:offsets[block + 1]]
    return simple8b.decode(words, np.frombuffer(page["escaped"], "<u8"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                page = {c: batch[c][row].as_py() for c in ("shard", "first", "words", "escaped")}
                doc_ids, lengths = batch["doc_ids"][row].values, batch["lengths"][row].values
                lengths = lengths.to_numpy()
                ends = np.cumsum(lengths)
                bytes_of = memoryview(read_ids(page).astype("<u4").tobytes())
                cuts = np.concatenate([[0], 4 * ends]).tolist()
                crc = [zlib.crc32(bytes_of[a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(lengths), page["shard"], np.int32)), doc_ids,
                    pa.array(page["first"] + ends - lengths), pa.array(lengths),
                    pa.array(crc, pa.int64())], names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    pages = spark.read.schema(PAGES).parquet(path)
    totals = pages.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("total"))
    # one row per task of the writer
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    found = pages.select("shard", "first", "words", "escaped", "doc_ids", "lengths").mapInArrow(digest, DIGESTS)
    return found.join(F.broadcast(begins), "shard").select(
        "doc_id", (F.col("begin") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
