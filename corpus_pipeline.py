"""Corpus pipeline: toxic documents go, repeated lines go, one of each near-duplicate group stays, packing.

Each stage is written as Parquet to the shared folder and read again as the next one's input. All but
the last return the columns of ``documents``. Rows with a null id are kept by every stage. Each stage sends
whole texts to Python in small batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.line_dedup import dedup_lines
from tallyline.llm.minhash_dedup import keep_first_of_group
from tallyline.llm.packing import pack
from tallyline.llm.store import fresh, small_batches, staged
from tallyline.llm.toxicity import toxicity
from tallyline.session import staging_root

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; of repeated rows with one id all stay or all go."""
    small_batches(spark)
    scored = staged(toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "score"), "scores")
    toxic_id = fresh("toxic_id")
    toxic = scored.where(F.col("score") >= TOXIC).select(F.col("doc_id").alias(toxic_id)).distinct()
    return docs.join(toxic, F.col("doc_id") == F.col(toxic_id), "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs; a document of which nothing is left goes, one that was blank stays."""
    blank = lambda text: F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")) == "", F.lit(True))
    was_blank = fresh("was_blank")
    cleaned = dedup_lines(docs.withColumn(was_blank, blank("text")))
    counted = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.where(F.col(was_blank) | ~blank("text")).drop(was_blank).withColumn("n_chars", counted)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_first_of_group(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


# Nearest neighbours, near duplicates on shingles and packing are not expressed in SQL; tests compare with brute force.
ORACLE_SQL = None
