"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyline.session import stage


_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python at most ``BATCH_ROWS`` at a time.

    Ten times as many whole texts, Spark's default, take tens of MB in each task's JVM buffers and again in its
    worker. The setting holds for the session, as it is read when a frame is executed, not when it is made.
    """
    before = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(before, BATCH_ROWS) if before > 0 else BATCH_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts lineage, outlives executors."""
    return stage(df, f"llm-{name}", compact=False)


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid.uuid4().hex}"
