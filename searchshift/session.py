"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: What a job on a large cluster should run with. Skewed joins are split at run
#: time even where the split costs one more shuffle: a hot backup is expected.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


#: Applications that have the package already.
_SHIPPED: set[str] = set()


def build_session(app: str = "searchshift", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the executors, once per application: Python functions travel by
    the name of their module, and executors need not see the driver's folders."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="searchshift-package-"), "searchshift.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    source = os.path.join(folder, name)
                    archive.write(source, os.path.join("searchshift", os.path.relpath(source, package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else the one given to
    ``SparkContext.setCheckpointDir``.

    A folder of our own is made only where neither is set and Spark runs in a single
    process; on a cluster a missing setting is an error, since a machine-local folder would
    not outlive a lost executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="searchshift-"))
    return context.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root, in a folder named after the application
    so that what a finished application left can be told apart."""
    application = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/{application}/{label}-{uuid.uuid4().hex[:12]}"


def shared_path(path: str) -> str:
    """The plain file-system path behind a ``file:`` address, for jobs that open files
    themselves. Other file systems cannot be written at an offset."""
    plain = path.removeprefix("file://").removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"not a mounted folder: {path}")
    return plain


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared scratch folder.

    Later passes read only the columns they need, and a lost executor costs a re-read
    instead of a recomputation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    """Tasks for work that costs time per row rather than per byte, such as listing
    folders or copying file ranges. Given as a number so that adaptive execution
    does not merge the few small rows into one task."""
    by_cores = 2 * spark.sparkContext.defaultParallelism
    if _is_local(spark):
        return by_cores
    # a cluster may still be growing when the job is planned
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), by_cores)
