"""Session settings the operators rely on, and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyline import folders


_UNLESS_SET = {
    # Dense files: what a task reads of them fits its memory where it is sorted before a shuffle.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Java compiles no method longer than this; Spark then splits the rules on a line into smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings for correct results: timestamps are wall clocks labelled UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Three open files per task: accepted, rejected and repeated lines are written without sorting them first.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    for name, value in _UNLESS_SET.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


_private_folders: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Without that setting a private folder is made, but only where all tasks run in this process:
    executors on other machines could not see it, so on a cluster the setting is required.
    """
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or _private_folders.get(application)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _private_folders[application] = tempfile.mkdtemp(prefix="tallyline-")
    return f"{shared.rstrip('/')}/tallyline/{application}"


_areas: list[list[str]] = []


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What the writes inside have shuffled leaves the disks when each of them ends, not at some later collection."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, also when the work in between fails."""
    _areas.append([])
    try:
        yield
    finally:
        for path in _areas.pop():
            folders.delete(spark, path)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None, compact: bool = True) -> DataFrame:
    """Write ``df`` to the shared staging folder as parquet and read it back.

    The returned frame has no lineage into the plan of ``df``: a lost executor re-reads files
    instead of recomputing the stages before, and readers prune columns and row groups. ``compact``:
    spend processor time on dense files, and drop at once what the write has shuffled.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _areas:
        _areas[-1].append(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compact:
        # Hashes are hex text, which Spark's default compression leaves at its full length.
        with shuffles_dropped(spark):
            writer.option("compression", "zstd").parquet(path)
    else:
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
