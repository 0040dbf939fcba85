"""Byte copies and checksums of files, cut into ranges that any task can do.

A large file is spread over the cluster, and each range is written at its own offset,
so a task that runs again writes the same bytes to the same place.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.crc import advance
from ..session import task_count

RANGE_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
RESULT = "path string, target string, bytes bigint, crc bigint, lead_crc bigint, ok boolean"
#: Bytes of a stored checksum at the end of a file, which it does not cover.
STORED = 8


def _process(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    folders: set[str] = set()
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            rows.append(_one_range(r.path, r.target, r.offset, r.bytes, r.total, folders))
        yield pd.DataFrame(rows, columns=[p.split()[0] for p in RESULT.split(", ")])


def _one_range(path, target, offset, count, total, folders):
    crc, lead, done, out = 0, 0, 0, None
    # bytes of this range that a stored checksum covers
    covered = max(0, min(count, total - STORED - offset))
    try:
        with open(path, "rb") as source:
            if target is not None:
                folder = os.path.dirname(target)
                if folder not in folders:
                    os.makedirs(folder, exist_ok=True)
                    folders.add(folder)
                out = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                if os.fstat(out).st_size > total:
                    os.ftruncate(out, total)
            while done < count:
                block = os.pread(source.fileno(), min(BLOCK_BYTES, count - done), offset + done)
                if not block:
                    break
                crc = zlib.crc32(block, crc)
                lead = zlib.crc32(block[:max(0, covered - done)], lead)
                if out is not None:
                    written = 0
                    while written < len(block):
                        written += os.pwrite(out, block[written:], offset + done + written)
                done += len(block)
    except OSError:
        return path, target, done, 0, 0, False
    finally:
        if out is not None:
            os.close(out)
    after = max(0, total - STORED - offset - covered)
    return path, target, done, advance(crc, total - offset - count), advance(lead, after), done == count


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """(path, target, total) cut into (offset, bytes); an empty file is one range."""
    pieces = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("total") / range_bytes))
    cut = files.select("path", "target", "total",
                       F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"))
    offset = F.col("piece") * range_bytes
    return cut.select("path", "target", offset.alias("offset"),
                      F.least(F.lit(range_bytes), F.col("total") - offset).alias("bytes"), "total")


def _run(files: DataFrame, range_bytes: int) -> DataFrame:
    spread = _ranges(files, range_bytes).repartition(
        task_count(files.sparkSession), "path", "offset")
    return spread.mapInPandas(_process, RESULT).groupBy("path", "target").agg(
        F.sum("bytes").alias("length"), F.bit_xor("crc").alias("crc"),
        F.bit_xor("lead_crc").alias("lead_crc"), F.min("ok").alias("ok"))


def copy_files(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Copy files (path, target, length) byte for byte, replacing what is there.

    Returns (path, target, length, crc, lead_crc, ok), the second checksum leaving out the
    last eight bytes; a source that is missing or shorter than stated is not ok."""
    return _run(files.select("path", "target", F.col("length").alias("total")), range_bytes)


def file_crc(files: DataFrame, leave_out: int = 0, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """CRC-32 of files (path, length), leaving out the given number of last bytes."""
    return _run(files.select(
        "path", F.lit(None).cast("string").alias("target"),
        F.greatest(F.lit(0).cast("bigint"), F.col("length") - leave_out).alias("total")),
        range_bytes).drop("target", "lead_crc")
