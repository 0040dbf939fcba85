"""File listings and file tails, read by the executors.

Spark's own file sources skip names that start with an underscore, and most files of
an index are named that way, so folders are listed through ``mapInPandas``. Paths must
be visible under the same name on every executor, as on a shared mount.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators.issues import issue_rows
from ..session import materialized, task_count

ENTRY = ("backup_id string, root string, rel_dir string, name string, is_dir boolean, "
         "length bigint, readable boolean, seen boolean")
BATCH = 10_000


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _unseen(backup_id, root, rel_dir, name) -> tuple:
    """A name found in a listing that nobody has looked at yet."""
    return backup_id, root, rel_dir, name, False, 0, False, False


def _look(backup_id, root, rel_dir, name) -> tuple:
    """An entry as it is, not yet listed if it is a folder."""
    path = os.path.join(root, rel_dir, name)
    try:
        status = os.stat(path)
    except OSError:
        return backup_id, root, rel_dir, name, False, 0, False, True
    is_dir = stat.S_ISDIR(status.st_mode)
    return (backup_id, root, rel_dir, name, is_dir, 0 if is_dir else status.st_size,
            os.access(path, os.R_OK), True)


def _in_batches(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield pd.DataFrame(held, columns=_columns(ENTRY))
            held = []
    if held:
        yield pd.DataFrame(held, columns=_columns(ENTRY))


def _children(folder: str) -> Iterator[str]:
    """Names in a folder; a listing that breaks off is an error."""
    with os.scandir(folder) as entries:
        for entry in entries:
            yield entry.name


def _stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Look at each entry, and name what is in it if it is a folder. A link is shown as the
    kind of its target but, other than a root, not followed.

    A folder is listed once, name by name; a listing that breaks off, wherever it does, is the
    folder's own outcome, an entry that is not readable, and ends nothing else."""
    def rows():
        for batch in batches:
            for r in batch.itertuples(index=False):
                is_root = not (r.rel_dir or r.name)
                if is_root and not os.path.lexists(r.root):
                    continue
                *entry, is_dir, length, readable, seen = _look(*r[:4])
                below = os.path.join(r.rel_dir, r.name) if r.rel_dir else r.name
                path = os.path.join(r.root, below) if below else r.root
                if is_dir and readable:
                    follow = is_root or not os.path.islink(path)
                    try:
                        for child in _children(path):
                            if follow:
                                yield _unseen(r.backup_id, r.root, below, child)
                    except OSError:
                        readable = False
                yield *entry, is_dir, length, readable, seen

    yield from _in_batches(rows())


def scan_files(roots: DataFrame) -> DataFrame:
    """Inventory of the folders in ``roots`` (backup_id, root).

    Folders are listed level by level until nothing is left, with a shuffle in between: a
    listing yields names only, and the look at each entry, which is what takes time, is
    spread over the cluster, however deep a tree is and however large one folder. Each
    level is written down, so a lost executor repeats one level at most. A root
    that does not exist gives no row; ``listing_issues`` names folders that could not be listed.
    """
    spark = roots.sparkSession
    tasks = task_count(spark)
    unseen = roots.select(
        "backup_id", "root", F.lit("").alias("rel_dir"), F.lit("").alias("name"),
        F.lit(False).alias("is_dir"), F.lit(0).cast("bigint").alias("length"),
        F.lit(False).alias("readable"), F.lit(False).alias("seen"))
    inventory = spark.createDataFrame([], ENTRY)
    while True:
        level = materialized(unseen.repartition(tasks, "root", "rel_dir", "name").mapInPandas(_stage, ENTRY), "level")
        inventory = inventory.unionByName(level.where("seen"))
        unseen = level.where("not seen")
        if unseen.isEmpty():
            return inventory.drop("seen")


def listing_issues(inventory: DataFrame) -> DataFrame:
    """Folders that exist and could not be listed to their end."""
    path = F.concat_ws("/", F.when(F.col("rel_dir") != "", F.col("rel_dir")), "name")
    return issue_rows(inventory.where("is_dir and not readable"), "LISTING_FAILED", path, F.lit(""))


OUTPUT = ("backup_id string, output_dir string, writable boolean, entries bigint, usable bigint, "
          "device bigint")


def _probe_outputs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            rows.append((r.backup_id, r.output_dir, *_probe(r.output_dir)))
        out = pd.DataFrame(rows, columns=_columns(OUTPUT))
        for column in ("entries", "usable", "device"):
            out[column] = out[column].astype("Int64")
        yield out


def _probe(folder: str) -> tuple:
    """(writable, entries, usable, device). What cannot be looked at is not writable."""
    existing = os.path.abspath(folder)
    try:
        while not os.path.exists(existing) and existing != os.path.dirname(existing):
            existing = os.path.dirname(existing)
        space, device = os.statvfs(existing), os.stat(existing).st_dev
        entries = sum(1 for _ in _children(folder)) if os.path.isdir(folder) else None
    except OSError:
        return False, None, None, None
    usable = os.path.isdir(existing) and os.access(existing, os.W_OK)
    return usable, entries, space.f_bavail * space.f_frsize, device


def scan_outputs(outputs: DataFrame) -> DataFrame:
    """State of output directories (backup_id, output_dir): writable, entries, space and
    the device that has it."""
    return outputs.select("backup_id", "output_dir").repartition(
        task_count(outputs.sparkSession), "output_dir").mapInPandas(_probe_outputs, OUTPUT)


def _read_tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        tails = []
        for path in batch["path"]:
            try:
                with open(path, "rb") as f:
                    f.seek(max(0, os.fstat(f.fileno()).st_size - rules.FOOTER_LENGTH))
                    tails.append(f.read(rules.FOOTER_LENGTH))
            except OSError:
                tails.append(None)
        yield batch.assign(tail=tails)


def read_tails(files: DataFrame) -> DataFrame:
    """Last 16 bytes of each file in ``path``; the rest is not read."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition(task_count(files.sparkSession), "path").mapInPandas(
        _read_tails, f"{schema}, tail binary")


#: A schema or a state is a few megabytes; a file beyond this is no such document.
MOST_BYTES = 256 << 20


def _reader(as_text: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.iloc[i:i + 1]
                try:
                    with open(one["path"].iloc[0], "rb") as f:
                        whole = f.read(MOST_BYTES + 1)
                except OSError:
                    whole = None
                if whole is not None and len(whole) > MOST_BYTES:
                    whole = None
                yield one.assign(content=[whole.decode("utf-8", "replace") if as_text and whole is not None else whole])

    return read


def read_documents(files: DataFrame) -> DataFrame:
    """Bytes of small files such as schemas and state documents, one per row; NULL where a
    file cannot be read or has more than ``MOST_BYTES``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition(task_count(files.sparkSession), "path").mapInPandas(
        _reader(as_text=False), f"{schema}, content binary")


def read_texts(files: DataFrame) -> DataFrame:
    """The same as text in UTF-8; bytes that are none show as replacement characters."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition(task_count(files.sparkSession), "path").mapInPandas(
        _reader(as_text=True), f"{schema}, content string")
