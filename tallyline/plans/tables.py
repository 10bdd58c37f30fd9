"""Warehouse tables as parquet folders under one root."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.folders import whole_path
from tallyline.session import shuffles_dropped


def read_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> DataFrame:
    """The stored table, or an empty one before the first load."""
    full = schema if partition is None else T.StructType([*schema.fields, T.StructField(partition, T.StringType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_folders(spark: SparkSession, path: str, names: list[str], schema: T.StructType, by: list[str] | None = None) -> DataFrame:
    """The named folders of a table; columns in ``by`` come from the names of folders below ``path``."""
    full = T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in by or []]])
    if not names:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("basePath", path) if by else spark.read.schema(full)
    return reader.parquet(*[f"{path}/{name}" for name in names])


@contextmanager
def bucketed_table(spark: SparkSession, path: str, schema: T.StructType, by: list[str], key: str, buckets: int,
                   partitions: list[dict[str, str]]) -> Iterator[DataFrame]:
    """A folder of bucketed files as a table of the session's catalogue, while the block runs.

    Spark knows from the table that rows lie in their buckets, so that a join on the key exchanges only
    the other side. Of a folder partitioned ``by`` columns only the listed partitions are read. The table is
    forgotten at the end, its files stay.
    """
    name = f"tallyline_{uuid.uuid4().hex[:12]}"
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], *[f"`{c}` string" for c in by]])
    partitioned = f"PARTITIONED BY ({', '.join(by)}) " if by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned}"
              f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION {text(whole_path(spark, path))}")
    try:
        if partitions:
            listed = " ".join("PARTITION (" + ", ".join(f"{c} = {text(v)}" for c, v in p.items()) + ")" for p in partitions)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, by: list[str] | None = None) -> None:
    """Write a new folder in buckets of the key's hash, inside partitions ``by`` columns. ``df``: dealt to as
    many partitions by the key, so that each task fills one bucket."""
    name = f"tallyline_{uuid.uuid4().hex[:12]}"
    try:
        writer = df.write.format("parquet").mode("errorifexists").bucketBy(buckets, key).option("path", whole_path(df.sparkSession, path))
        with shuffles_dropped(df.sparkSession):
            (writer.partitionBy(*by) if by else writer).option("compression", "zstd").saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # the files lie in a folder of their own and stay


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("date_id", "yyyy-MM"))


def append_by_month(df: DataFrame, path: str) -> None:
    """Add rows to a table partitioned by month.

    The rebalance hint gives each month few, evenly sized files and splits a month that is large.
    """
    with shuffles_dropped(df.sparkSession):
        with_month(df).hint("rebalance", "month").write.mode("append").partitionBy("month").option("compression", "zstd").parquet(path)
