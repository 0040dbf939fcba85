"""Writing documents and batches as files from the executors."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import running_total
from ..session import materialized, task_count

WRITTEN = "root string, rel_path string, bytes bigint, ok boolean"


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies are written from where Arrow has them, with no copy in Python."""
    folders: set[str] = set()
    for batch in batches:
        roots, paths, offsets, totals = (batch.column(c).to_pylist() for c in ("root", "rel_path", "offset", "total"))
        written, ok = [], []
        for i, stored in enumerate(batch.column("body")):
            body = memoryview(stored.as_buffer())
            try:
                _put(os.path.join(roots[i], paths[i]), body, offsets[i], totals[i], folders)
            except OSError:  # one bad target must not end the job for the others
                written.append(0)
                ok.append(False)
            else:
                written.append(len(body))
                ok.append(True)
        # the bodies go before the next ones come
        batch = stored = body = None
        yield pa.RecordBatch.from_arrays(
            [pa.array(roots, pa.string()), pa.array(paths, pa.string()), pa.array(written, pa.int64()), pa.array(ok, pa.bool_())],
            ["root", "rel_path", "bytes", "ok"])


def _put(path: str, body: memoryview, offset: int, total: int, folders: set[str]) -> None:
    folder = os.path.dirname(path)
    if folder not in folders:
        os.makedirs(folder, exist_ok=True)
        folders.add(folder)
    out = os.open(path, os.O_WRONLY | os.O_CREAT, 0o644)
    try:
        if os.fstat(out).st_size > total:
            os.ftruncate(out, total)
        done = 0
        while done < len(body):
            done += os.pwrite(out, body[done:], offset + done)
    finally:
        os.close(out)


def write_repository(parts: DataFrame) -> DataFrame:
    """Write document parts (root, rel_path, part, body) and return the files written:
    (root, rel_path, length, parts, ok); a file with a part that could not be written is not
    ok. A part that occurs twice is an error, as the file would be neither of the two.

    Each part goes to its own offset in the file, which follows from the lengths of
    the parts before it, so one long document is written by many tasks, and a task
    that runs again repeats the same write.
    """
    keys = ["root", "rel_path"]
    tasks = task_count(parts.sparkSession)
    sized = parts.withColumn("body", F.col("body").cast("binary"))
    sized = materialized(sized.withColumn("bytes", F.octet_length("body").cast("bigint")), "parts")
    twice = sized.groupBy(*keys, "part").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"part {twice['part']} of {twice['root']}/{twice['rel_path']} occurs {twice['n']} times")
    places = running_total(sized.select(*keys, "part", "bytes"), keys, "part", "bytes",
                           before="offset", total="total")
    # both sides laid out for the join in the partitions that write: one move of the bodies
    bodies = sized.select(*keys, "part", "body").repartition(tasks, *keys, "part")
    offsets = places.select(*keys, "part", "offset", "total").repartition(tasks, *keys, "part")
    written = bodies.join(offsets, [*keys, "part"]).select(
        *keys, "body", "offset", "total").mapInArrow(_write, WRITTEN)
    return written.groupBy(*keys).agg(F.sum("bytes").alias("length"), F.count("*").alias("parts"),
                                      F.min("ok").alias("ok"))


def write_files(files: DataFrame) -> DataFrame:
    """Write whole files (root, rel_path, body), one row each, and return the same as
    ``write_repository``."""
    body = F.col("body").cast("binary")
    written = files.select(
        "root", "rel_path", body.alias("body"), F.lit(0).cast("bigint").alias("offset"),
        F.octet_length(body).cast("bigint").alias("total")).mapInArrow(_write, WRITTEN)
    return written.select("root", "rel_path", F.col("bytes").alias("length"),
                          F.lit(1).cast("bigint").alias("parts"), "ok")


MOVED = "backup_id string, ok boolean"


def _move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(r.backup_id, _put_in_place(os.path.join(r.staged, r.rel_path), os.path.join(r.target, r.rel_path), r.length))
                for r in batch.itertuples(index=False)]
        yield pd.DataFrame(rows, columns=["backup_id", "ok"])


def _put_in_place(staged: str, place: str, length: int) -> bool:
    """Move one file. What an attempt that was lost has moved is there already, with its length."""
    try:
        if os.path.getsize(staged if os.path.lexists(staged) else place) != length:
            return False
        if os.path.lexists(staged):
            os.makedirs(os.path.dirname(place), exist_ok=True)
            os.replace(staged, place)
        return True
    except OSError:
        return False


def _tidy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Remove the folders that are empty now; a file that no manifest names stays."""
    for batch in batches:
        for staged in batch["staged"]:
            for folder, _, _ in os.walk(staged, topdown=False):
                try:
                    os.rmdir(folder)
                except OSError:
                    pass
        yield batch[["backup_id"]].assign(ok=True)


def publish_files(files: DataFrame, last: str) -> DataFrame:
    """Move the files of a manifest (backup_id, staged, target, rel_path, length) from where they were
    written and checked to where they belong, within one file system: (backup_id, ok).

    Exactly these files are moved, whatever else lies in the staging folder. The file named ``last``
    follows when all others of its backup are in place, so what it points to is whole; a backup is
    ok when that is in place too. Every move can be repeated."""
    tasks = task_count(files.sparkSession)
    columns = ["backup_id", "staged", "target", "rel_path", "length"]
    files = materialized(files.select(columns), "to-publish")
    first = materialized(files.where(F.col("rel_path") != last).repartition(tasks, "backup_id", "rel_path")
                         .mapInPandas(_move, MOVED).groupBy("backup_id").agg(F.min("ok").alias("ok")), "published")
    pointers = files.where(F.col("rel_path") == last).join(first.where("ok").select("backup_id"), "backup_id", "left_semi")
    done = materialized(pointers.select(columns).repartition(tasks, "backup_id").mapInPandas(_move, MOVED), "pointers")
    pointers.join(done.where("ok").select("backup_id"), "backup_id", "left_semi").select("backup_id", "staged").repartition(
        tasks, "backup_id").mapInPandas(_tidy, MOVED).write.format("noop").mode("overwrite").save()
    return first.select("backup_id").join(done, "backup_id", "left").select(
        "backup_id", F.coalesce("ok", F.lit(False)).alias("ok"))


def batch_documents(batches: DataFrame) -> DataFrame:
    """One JSON array per batch of at most the batch size: (rel_path, body)."""
    columns = [c for c in batches.columns if c not in ("batch", "row_index")]
    record = F.to_json(F.struct(*columns))
    return batches.select("batch", "row_index", record.alias("record")).groupBy("batch").agg(
        F.concat(F.lit("["), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("row_index", "record"))),
            lambda r: r["record"]), ","), F.lit("]")).alias("body")
    ).select(F.format_string("batch_%d.json", "batch").alias("rel_path"), "body")


def write_batches(batches: DataFrame, root: str) -> DataFrame:
    """One JSON file per batch below ``root``."""
    return write_files(batch_documents(batches).withColumn("root", F.lit(root)))
