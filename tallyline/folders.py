"""Small file operations in the storage that Spark writes to, whatever kind it is."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def whole_path(spark: SparkSession, path: str) -> str:
    """With its storage, and from the root on: tables of the catalogue take a relative path to be below its own folder."""
    store, place = _open(spark, path)
    return store.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _open(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    store, place = _open(spark, path)
    store.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; empty if there is no such folder."""
    store, place = _open(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(place)] if store.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file; runs no job."""
    store, place = _open(spark, path)
    stream = store.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    store, place = _open(spark, path)
    stream = store.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole file appear under a name that is free; False if another one has taken the name.

    The file is written under a hidden name and renamed without overwriting, which the storage does in
    one step. A local disk would overwrite, so that there a link is made instead.
    """
    store, place = _open(spark, path)
    hidden = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    java = spark.sparkContext._jvm
    try:
        if store.getUri().getScheme() == "file":
            os.link(*[store.makeQualified(_open(spark, name)[1]).toUri().getPath() for name in (hidden, path)])
        else:
            options = spark.sparkContext._gateway.new_array(java.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = java.org.apache.hadoop.fs.Options.Rename.NONE
            java.org.apache.hadoop.fs.FileContext.getFileContext(
                place.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(_open(spark, hidden)[1], place, options)
        return True
    except Exception:
        if store.exists(place):
            return False
        raise
    finally:
        delete(spark, hidden)
