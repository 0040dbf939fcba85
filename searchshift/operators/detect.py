"""Format detection over an inventory of many backups.

``inventory`` has one row per entry: (backup_id, rel_dir, name, is_dir, length,
readable). The row with an empty name is the backup root itself; the root's own
entries have an empty ``rel_dir``. Names are unique inside a directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.values import commit_generation, join_path
from .issues import issue_rows
from .joins import join_parents, join_shuffled

#: Shards of a backup that are planned in one place, as a power of two.
BLOCK_BITS = 10


def _is_root() -> Column:
    return (F.col("rel_dir") == "") & (F.col("name") == "")


def _is_incremental_marker() -> Column:
    return (F.col("name") == rules.INCREMENTAL_MARKER) & ~F.col("rel_dir").contains("/")


def _is_commit() -> Column:
    return F.col("name").startswith(rules.COMMIT_PREFIX)


def _is_shard_dir() -> Column:
    return F.col("is_dir") & (F.col("rel_dir") == "") & F.col("name").rlike(rules.SHARD_DIR_REGEX)


def incremental_backups(inventory: DataFrame) -> DataFrame:
    """Backups that carry the incremental marker in the root or in a direct child."""
    return (
        inventory.filter(_is_incremental_marker())
        .groupBy("backup_id")
        .agg(F.max(F.col("rel_dir") == "").alias("in_root"), F.count("*").alias("markers"))
    )


def completed_backups(inventory: DataFrame) -> DataFrame:
    """Backups whose root holds the completion marker."""
    return (
        inventory.filter((F.col("rel_dir") == "") & (F.col("name") == rules.COMPLETION_MARKER))
        .select("backup_id").distinct()
    )


def shard_dirs(inventory: DataFrame) -> DataFrame:
    """Shard directories with their numbers.

    Shards are ordered by number. In an accepted backup the numbers are 1..k, so the
    0-based shard id is the number minus one and needs no ranking; for the others
    ``shard_gaps`` says where the numbering breaks. A number beyond the integer range
    is NULL.
    """
    digits = F.regexp_extract("name", rules.SHARD_DIR_REGEX, 1)
    number = digits.try_cast("int").cast("bigint")
    return inventory.filter(_is_shard_dir()).select(
        "backup_id", F.col("name").alias("dir"),
        number.alias("shard_number"), (number - 1).alias("shard_id"))


def unmatched_shard_dirs(inventory: DataFrame) -> DataFrame:
    """Warn on directories that look like shards but are not detected as such."""
    odd = inventory.filter(
        F.col("is_dir") & (F.col("rel_dir") == "")
        & F.col("name").startswith(rules.SHARD_DIR_LOOSE_PREFIX)
        & ~F.col("name").rlike(rules.SHARD_DIR_REGEX))
    return issue_rows(odd, "UNMATCHED_SHARD_DIR", F.col("name"), F.lit("ignored"))


def _mark(number: Column, copies: int = 0, **facts: Column) -> Column:
    """A statement about one shard number; unmentioned facts are false or zero. The facts
    are bits of one number, so that a group's buffer is two numbers; an unknown fact makes
    a NULL, which counts only where nothing else is said."""
    bits = F.lit(0)
    for name, fact in facts.items():
        bits = bits + F.when(fact, F.lit(1 << _FLAGS.index(name))).when(~fact, F.lit(0))
    return F.struct(number.cast("bigint").alias("n"), F.lit(copies).cast("bigint").alias("copies"),
                    bits.cast("int").alias("flags"))


_FLAGS = ("before", "after", "commit", "is_directory", "incremental", "standalone", "out_of_range")


def _flag(name: str) -> Column:
    """One fact of ``flags``; NULL where nothing is known."""
    return F.col("flags").bitwiseAND(F.lit(1 << _FLAGS.index(name))) != 0


def _shard_marks(number: Column) -> list[Column]:
    """A shard announces itself to its own number and to both neighbours."""
    yes = F.lit(True)
    return [_mark(number, copies=1), _mark(number + 1, before=yes),
            _mark(number - 1, after=yes)]


def _by_number(marks: DataFrame) -> DataFrame:
    """All statements about one number of one backup."""
    return marks.select("backup_id", "m.*").groupBy("backup_id", "n").agg(
        F.sum("copies").alias("copies"), F.bit_or("flags").alias("flags"))


def _first_mismatch() -> tuple[list[Column], Column]:
    """Aggregates per backup over ``_by_number`` rows, and the first place where the
    sorted numbers differ from 1, 2, 3, ..., as a struct or NULL."""
    n, here = F.col("n"), F.col("copies") > 0
    aggregates = [
        F.max(here & (n == 0)).alias("has_zero"),
        F.max(here & (n == 1)).alias("has_one"),
        F.min(F.when(F.col("copies") > 1, n)).alias("repeated"),
        F.min(F.when(here & ~_flag("before") & (n != 1), n)).alias("restart"),
        F.min(F.when(here & ~_flag("after"), n)).alias("run_end"),
    ]
    # the smallest number from 1 on that is not there
    missing = F.when(F.col("has_one"), F.col("run_end") + 1).otherwise(F.lit(1).cast("bigint"))

    def pair(expected: Column, actual: Column) -> Column:
        return F.struct(expected.cast("bigint").alias("expected"),
                        actual.cast("bigint").alias("actual"))

    mismatch = (
        F.when(F.col("has_zero"), pair(F.lit(1), F.lit(0)))
        .when(F.col("repeated") < missing, pair(F.col("repeated") + 1, F.col("repeated")))
        .when(F.col("restart") > missing, pair(missing, F.col("restart")))
    )
    return aggregates, mismatch


def shard_gaps(shards: DataFrame) -> DataFrame:
    """First place where a backup's sorted shard numbers differ from 1, 2, 3, ...

    Every number announces itself to its two neighbours. After that one aggregation
    by (backup, number) knows where runs of consecutive numbers start and end, and a
    second one by backup reduces to a handful of minima. Nothing is sorted, and a
    backup with most of the shards is spread by number.
    """
    marks = shards.filter(F.col("shard_number").isNotNull()).select(
        "backup_id", F.explode(F.array(*_shard_marks(F.col("shard_number")))).alias("m"))
    aggregates, mismatch = _first_mismatch()
    return (
        _by_number(marks).groupBy("backup_id").agg(*aggregates)
        .select("backup_id", mismatch.alias("gap"))
        .filter(F.col("gap").isNotNull())
        .select("backup_id", "gap.expected", "gap.actual")
    )


def shards_without_commit(shards: DataFrame, inventory: DataFrame) -> DataFrame:
    """Shard directories that hold no commit file."""
    commits = inventory.filter(_is_commit()).select(
        "backup_id", F.col("rel_dir").alias("dir")).distinct()
    return shards.join(commits, ["backup_id", "dir"], "left_anti")


def standalone_index(inventory: DataFrame) -> DataFrame:
    """Where a single-index backup keeps its commit: the root, else ``index/``."""
    return (
        inventory.filter(_is_commit() & F.col("rel_dir").isin(*rules.STANDALONE_DIRS))
        .groupBy("backup_id")
        .agg(F.when(F.max(F.col("rel_dir") == ""), F.lit("")).otherwise(F.lit("index"))
             .alias("index_dir"))
    )


def classify_format(inventory: DataFrame) -> DataFrame:
    """Format of every backup, or the code of the reason for refusing it.

    One pass and no join: every relevant entry makes statements about a shard number
    (or about the backup as a whole, under a NULL number), which are gathered by
    (backup, number) and then by backup.
    """
    shard_of_dir = F.regexp_extract("rel_dir", rules.SHARD_DIR_REGEX, 1)
    number = F.regexp_extract("name", rules.SHARD_DIR_REGEX, 1).try_cast("int").cast("bigint")
    whole = F.lit(None).cast("bigint")
    yes = F.lit(True)
    single = _is_commit() & F.col("rel_dir").isin(*rules.STANDALONE_DIRS)
    marks = (
        F.when(_is_root(), F.array(_mark(whole, is_directory=F.col("is_dir"))))
        .when(_is_incremental_marker(), F.array(_mark(whole, incremental=yes)))
        .when(_is_shard_dir() & number.isNull(), F.array(_mark(whole, out_of_range=yes)))
        .when(_is_shard_dir(), F.array(*_shard_marks(number)))
        .when(single, F.array(_mark(whole, standalone=yes)))
        .when(_is_commit() & (shard_of_dir != ""),
              F.array(_mark(shard_of_dir.try_cast("int"), commit=yes)))
    )
    # a filter the scan can apply: most entries are data files inside a shard
    relevant = inventory.filter((F.col("rel_dir") == "") | _is_commit()
                                | (F.col("name") == rules.INCREMENTAL_MARKER))
    points = _by_number(relevant.select("backup_id", F.explode(marks).alias("m")))
    aggregates, mismatch = _first_mismatch()
    facts = points.groupBy("backup_id").agg(
        *aggregates,
        F.bit_or("flags").alias("flags"),
        F.sum("copies").alias("shards"),
        F.count_if((F.col("copies") > 0) & ~_flag("commit")).alias("bare_shards"),
    ).withColumn("gap", mismatch)
    code = (
        F.when(~_flag("is_directory"), F.lit("NOT_A_DIRECTORY"))
        .when(_flag("incremental"), F.lit("INCREMENTAL_BACKUP"))
        .when(_flag("out_of_range"), F.lit("SHARD_NUMBER_RANGE"))
        .when(F.col("gap").isNotNull(), F.lit("SHARD_GAP"))
        .when(F.col("bare_shards") > 0, F.lit("SHARD_WITHOUT_COMMIT"))
        .when((F.col("shards") == 0) & ~F.coalesce(_flag("standalone"), F.lit(False)), F.lit("UNKNOWN_FORMAT"))
    )
    accepted = F.col("issue_code").isNull()
    return facts.withColumn("issue_code", code).select(
        "backup_id",
        F.when(accepted & (F.col("shards") > 0), F.lit(rules.CLOUD_FULL))
        .when(accepted, F.lit(rules.STANDALONE)).alias("format"),
        "issue_code",
        F.when(F.col("issue_code") == "SHARD_GAP",
               F.format_string("expected %d, found %d", "gap.expected", "gap.actual"))
        .when(F.col("issue_code") == "SHARD_WITHOUT_COMMIT", F.col("bare_shards").cast("string"))
        .alias("detail"),
        F.when(accepted, F.greatest(F.col("shards"), F.lit(1).cast("bigint"))).alias("shard_count"))


def detection_issues(formats: DataFrame) -> DataFrame:
    """Refused backups as issue rows."""
    return formats.filter(F.col("issue_code").isNotNull()).select(
        "backup_id", F.lit("ERROR").alias("severity"), F.col("issue_code").alias("code"),
        F.lit("").alias("subject"), F.coalesce("detail", F.lit("")).alias("detail"))


def resolve_schema_path(inventory: DataFrame,
                        candidates: tuple[str, ...] = rules.SCHEMA_CANDIDATES) -> DataFrame:
    """First existing schema file of the ranked candidates."""
    path = join_path(F.col("rel_dir"), F.col("name"))
    ranked = F.array(*[F.lit(c) for c in candidates])
    folders, names = zip(*[("/" + c).rsplit("/", 1) for c in candidates])
    # folder and name on their own first: a filter the scan can apply
    possible = F.col("rel_dir").isin(*{f.removeprefix("/") for f in folders}) & F.col("name").isin(*set(names))
    return (
        inventory.filter(possible & path.isin(*candidates))
        .groupBy("backup_id")
        .agg(F.min(F.array_position(ranked, path)).alias("rank"))
        .select("backup_id", F.element_at(ranked, F.col("rank").cast("int")).alias("schema_path"))
    )


def resolve_replicas(plan: DataFrame, explicit: str | None = None) -> DataFrame:
    """Replica count and where it comes from.

    ``explicit`` names an optional column with the requested count. The replication
    factor counts copies, so the replicas are one fewer; it is known only for
    sharded backups.
    """
    factor = F.coalesce("replication_factor", F.lit(-1))
    factor = F.when(F.col("format") == rules.STANDALONE, F.lit(-1)).otherwise(factor)
    wanted = F.col(explicit) if explicit else F.lit(None).cast("int")
    return (
        plan.withColumn("replication_factor", factor)
        .withColumn("replicas", F.when(wanted >= 0, wanted)
                    .when(factor > 0, factor - 1).otherwise(F.lit(0)))
        .withColumn("replica_source", F.when(wanted >= 0, F.lit("explicit"))
                    .when(factor > 0, F.lit("replication_factor")).otherwise(F.lit("default")))
    )


def conversion_plan(formats: DataFrame, schema_paths: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per accepted backup. Its shards are rows of ``plan_shards``."""
    plan = (
        formats.filter(F.col("format").isNotNull()).select("backup_id", "format", "shard_count")
        .join(schema_paths, "backup_id", "left")
        .join(factors.select("backup_id", "replication_factor"), "backup_id", "left")
    )
    return resolve_replicas(plan)


def plan_shards(formats: DataFrame, shards: DataFrame, standalone: DataFrame) -> DataFrame:
    """Shards of the accepted backups: (backup_id, shard_id, dir).

    Where ``formats`` tells the ``shard_count``, a backup has one row for each block of its
    shard numbers, which are dense: most backups have one, and a large one is dealt out."""
    candidates = shards.select(
        "backup_id", "shard_id", "dir", F.lit(rules.CLOUD_FULL).alias("format")
    ).unionByName(standalone.select(
        "backup_id", F.lit(0).cast("bigint").alias("shard_id"), F.col("index_dir").alias("dir"),
        F.lit(rules.STANDALONE).alias("format")))
    accepted = formats.filter(F.col("format").isNotNull())
    if "shard_count" in formats.columns:
        last = F.greatest(F.coalesce("shard_count", F.lit(1)), F.lit(1)).cast("bigint") - 1
        blocks = accepted.select("backup_id", "format", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.shiftright(last, BLOCK_BITS))).alias("_block"))
        placed = candidates.withColumn("_block", F.shiftright("shard_id", BLOCK_BITS))
        return join_shuffled(placed, blocks, ["backup_id", "format", "_block"], "left_semi").drop("_block", "format")
    accepted = accepted.select("backup_id", "format")
    return join_parents(candidates, accepted, ["backup_id", "format"], spread=["shard_id"],
                        how="left_semi").drop("format")


def latest_commit(inventory: DataFrame) -> DataFrame:
    """Newest commit of every directory, under the name it has there; generations are
    compared as numbers, equal ones by name."""
    generation = commit_generation(F.col("name"))
    return (
        inventory.filter(~F.col("is_dir") & generation.isNotNull())
        .groupBy("backup_id", F.col("rel_dir").alias("dir"))
        .agg(F.max(F.struct(generation.alias("generation"), "name")).alias("newest"))
        .select("backup_id", "dir", "newest.generation", F.col("newest.name").alias("commit_file"))
    )


def commit_name_issues(inventory: DataFrame) -> DataFrame:
    """Files named like commits whose generation cannot be read."""
    odd = inventory.filter(~F.col("is_dir") & F.col("name").startswith(rules.COMMIT_PREFIX)
                           & commit_generation(F.col("name")).isNull())
    return issue_rows(odd, "COMMIT_NAME_INVALID", F.col("rel_dir"), F.col("name"))


def referenced_files(segments: DataFrame) -> DataFrame:
    """File names a commit refers to, one row per file."""
    return segments.select("backup_id", "shard_id", F.explode("files").alias("name"))


def live_files(segments: DataFrame, files: DataFrame) -> DataFrame:
    """Files that the commit refers to and that exist; others stay behind.

    ``files`` is the inventory by shard: (backup_id, shard_id, name, length)."""
    referenced = referenced_files(segments)
    return files.join(referenced, ["backup_id", "shard_id", "name"], "left_semi")


def missing_files(segments: DataFrame, files: DataFrame) -> DataFrame:
    """Referenced files that do not exist, as warnings; they are skipped."""
    absent = referenced_files(segments).join(
        files, ["backup_id", "shard_id", "name"], "left_anti").distinct()
    return issue_rows(absent, "FILE_MISSING",
                      F.concat(F.lit("shard "), (F.col("shard_id") + 1).cast("string")), F.col("name"))
