"""Deletion of repeated runs of lines, found by winnowing over line hashes.

Lines are compared without blanks at their ends; blank lines are passed over. A unit is ``WINDOW``
consecutive lines, or one or two of at least ``LONG`` words together: so every run of as many lines or words
that occurs again is made up of units. Of each unit the least line hash is
selected: equal units have equal minima, so every repeated unit has a repeated fingerprint, and units
whose fingerprint occurs in one place only are dropped before anything else is exchanged. The places
of the others are joined with the first place of an equal unit, in the order of document id and line.
A unit that occurs earlier, without overlapping it in the same document, is deleted; adjacent and
overlapping ones make up a run. All units are compared; matches are not extended line by line.

The first place is a minimum, combined before the exchange, so a line that is everywhere does not
meet in one task and no pairs are written out. Null texts stay null, empty ones empty. Rows with a
null id take no part and stay whole; repeated rows with one id are one place and are treated alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import bloom
from tallyline.llm.store import fresh, small_batches, staged
from tallyline.llm.words import forget_encoders, texts_of

WINDOW, LONG = 3, 50
# Documents whose units a task makes at once: each unit is several Python objects.
ROWS = 256

_UNIT = pa.schema([("id", pa.int64()), ("place", pa.int64()), ("lines", pa.int32()), ("first_line", pa.int64()),
                   ("last_line", pa.int64()), ("finger", pa.int64()), ("mark", pa.binary())])


def units_of(text: bytes) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """(place, lines, first line, last line, fingerprint, mark) of each unit; lines are numbered from 0."""
    kept = [(n, line) for n, line in enumerate(map(bytes.strip, text.split(b"\n"))) if line]
    hashes = np.array([xxhash.xxh3_64_intdigest(line) for _, line in kept], np.uint64).view(np.int64)
    marks = [xxhash.xxh3_128_digest(line) for _, line in kept]
    for i in range(len(kept) - WINDOW + 1):
        whole = xxhash.xxh3_128_digest(b"".join(marks[i:i + WINDOW]))
        yield i, WINDOW, kept[i][0], kept[i + WINDOW - 1][0], int(hashes[i:i + WINDOW].min()), whole
    # Fewer lines are a unit if they hold enough words; so many words need as many letters and gaps.
    words = functools.cache(lambda i: len(kept[i][1].split()))
    sizes = [len(line) for _, line in kept]
    for i, (n, _) in enumerate(kept):
        if sizes[i] >= 2 * LONG - 1 and words(i) >= LONG:
            yield i, 1, n, n, int(hashes[i]), marks[i]
        if sum(sizes[i:i + 2]) >= 2 * LONG - 2 and i + 1 < len(kept) and words(i) + words(i + 1) >= LONG:
            yield i, 2, n, kept[i + 1][0], int(hashes[i:i + 2].min()), xxhash.xxh3_128_digest(marks[i] + marks[i + 1])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_encoders()
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
        rows = [(key, *unit) for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))) for unit in units_of(text)]
        columns = zip(*rows) if rows else [[]] * len(_UNIT)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _UNIT.types)], schema=_UNIT)


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_line, last_line, source_id, source_line) of each unit that occurs earlier, and where first."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    units = staged(texts.mapInArrow(_units, "id long, place long, lines int, first_line long, last_line long, finger long, mark binary"),
                   "units")
    fingers = units.groupBy("finger").agg(F.count("*").alias("n")).where("n > 1").select("finger")
    met = staged(units.join(fingers, "finger", "left_semi").drop("finger"), "met-units")
    first = met.groupBy("mark", "lines").agg(F.min(F.struct("id", "place", "first_line")).alias("source"), F.count("*").alias("n"))
    later = met.join(first.where("n > 1"), ["mark", "lines"]).where(
        "id > source.id OR (id = source.id AND place >= source.place + lines)")
    return later.select("id", "first_line", "last_line", F.col("source.id").alias("source_id"),
                        F.col("source.first_line").alias("source_line"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs) of documents with lines to delete; runs: spans (first_line, last_line), not merged."""
    return repeated_units(docs, id_col, text_col).groupBy("id").agg(
        F.sort_array(F.collect_set(F.struct("first_line", "last_line"))).alias("runs")).withColumnRenamed("id", id_col)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, runs: pd.Series) -> pd.Series:
    out = []
    for text, spans in zip(texts, runs):
        lines, rest, at = text.split("\n"), [], 0
        for span in spans:
            rest.extend(lines[at:span["first_line"]])
            at = max(at, span["last_line"] + 1)
        out.append("\n".join(rest + lines[at:]))
    return pd.Series(out, dtype=object)


# Else a filter on the result makes Spark evaluate it once for the filter and once for the column, in a worker each.
_without = _without.asNondeterministic()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, later repeated runs of lines deleted from the text.

    Texts without such runs are not exchanged: a filter of bounded size on the ids lets them pass.
    """
    small_batches(docs.sparkSession)
    run_id, held, changes = fresh("run_id"), fresh("runs"), fresh("may_change")
    runs = staged(repeated_runs(docs, id_col, text_col).select(F.col(id_col).alias(run_id), F.col("runs").alias(held)), "runs")
    table = bloom.build(runs.select(F.xxhash64(run_id).alias("hash")))

    @F.pandas_udf("boolean")
    def may_change(hashes: pd.Series) -> pd.Series:
        return pd.Series(bloom.may_hold(table, hashes.to_numpy(np.int64)))

    key = F.col(id_col).cast("long")
    marked = docs.withColumn(changes, key.isNotNull() & may_change.asNondeterministic()(F.xxhash64(key)))
    some = marked.where(F.col(changes)).drop(changes)
    some = some.join(runs, some[id_col].cast("long") == runs[run_id], "left").withColumn(
        text_col, F.when(F.col(held).isNull() | F.col(text_col).isNull(), F.col(text_col)).otherwise(
            _without(F.coalesce(text_col, F.lit("")), F.coalesce(held, F.array().cast("array<struct<first_line:bigint,last_line:bigint>>")))))
    return marked.where(~F.col(changes)).drop(changes).unionByName(some.drop(run_id, held))
