"""Token-id files: documents in ascending order of their id, ids coded by ``context_coder``.

A file set is a folder of Parquet files with one row per segment: its range partition, its number in
it, its numbers of documents and ids, and the coded segment, which also holds each document's key and
length. Documents are not cut between segments. Where a document starts among all ids follows from
the counts of the partitions and segments before it, which are read without the coded data.

Null and empty texts are the end id alone. Null keys come first; rows with one key stay separate, in
the order of their texts' hashes. Only key and text are written, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.context_coder import decode_segment, encode_segment
from tallyline.llm.words import gathered, word_ids

# Ids after which a segment is closed: about 6000 blocks side by side.
SEGMENT = 6 << 20
BATCH_IDS = 1 << 20

_SEGMENTS = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                       ("data", pa.binary())])
_FILE = "part long, segment long, n_docs long, n_ids long, data binary"


def _written(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, segment = word_ids(path), TaskContext.get().partitionId(), 0
        keys, parts, sizes, held = [], [], [], 0

        def given() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            extra = b"".join(np.array(x, "<i8").tobytes() for x in ([k is None for k in keys], [k or 0 for k in keys], sizes))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (part, segment, len(keys), len(ids), encode_segment(ids, extra)), _SEGMENTS.types)], schema=_SEGMENTS)

        for batch in gathered(batches):
            for key, ids in zip(batch.column(0).to_pylist(), encoder.each(batch.column(1))):
                ids = np.append(ids, np.array(end_id, encoder.dtype))
                keys.append(key)
                parts.append(ids)
                sizes.append(len(ids))
                held += len(ids)
                if held >= SEGMENT:
                    yield given()
                    keys, parts, sizes, held, segment = [], [], [], 0, segment + 1
        if keys:
            yield given()
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Write all documents, each followed by ``end_id``, to a folder that all executors share."""
    pairs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _written(tokenizer, end_id), _FILE).write.parquet(path)


_ROWS = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, start in zip(batch.column("data"), batch.column("start").to_pylist()):
            ids, extra = decode_segment(data.as_py())
            missing, keys, sizes = np.frombuffer(extra, "<i8").reshape(3, -1)
            ends = np.cumsum(sizes)
            firsts, wide = ends - sizes, ids.astype("<u4")
            cut = np.flatnonzero(np.diff(firsts // BATCH_IDS, prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(keys)]):
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[a:b], mask=missing[a:b].astype(bool)), pa.array(firsts[a:b] + start), pa.array(sizes[a:b]),
                    pa.array([wide[i:j].tobytes() for i, j in zip(firsts[a:b], ends[a:b])], pa.binary())], schema=_ROWS)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of every document; start: ids of all documents before it.

    ids: little-endian unsigned 32-bit integers.
    """
    files = spark.read.schema(_FILE).parquet(path)
    # One number per range partition of the writer.
    sums = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = {}, 0
    for part, n in sums:
        before[part] = total
        total += n

    @F.pandas_udf(T.LongType())
    def part_start(parts: pd.Series) -> pd.Series:
        return parts.map(before).astype("int64")

    inside = F.coalesce(F.sum("n_ids").over(
        W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    earlier = files.select("part", "segment", inside.alias("inside"))
    starts = earlier.select("part", "segment", (part_start("part") + F.col("inside")).alias("start"))
    rows = files.select("part", "segment", "data").join(starts, ["part", "segment"]).select("data", "start").mapInArrow(
        _read, "id long, start long, n_tokens long, ids binary")
    return rows.withColumnRenamed("id", id_col)
