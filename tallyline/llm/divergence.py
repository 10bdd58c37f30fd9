"""How the sources of each language differ in the words they use.

A task lower-cases its texts (A-Z only), splits them into terms, encodes these as a dictionary and counts
them by hash grouping, all as Arrow kernels on pieces of a batch; it hands on partial counts (language,
source, term, occurrences, documents). Partial counts are merged per term; terms in too few documents of
a language go. The merged counts are dealt by the hash of the term into shards of at most about ``CELLS``
(term, source) cells. A shard holds all sources of its terms as columns of whole numbers, and gives its
share of the distance of each pair of sources and its ``RANKS`` most overused terms per source; the shares
are summed, the terms ranked again.

Shares are 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers: the quotient is taken in three
steps of 1,000, exact as long as N + 5 V is below 9 * 10^15. Null languages, sources and texts are read as
empty; each row is a document, also a repeated one. A group without terms takes part; in a language
without kept terms all values are 0. A text of any length is counted whole. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyline.llm.store import staged

LEAST_DOCUMENTS, RANKS, ADDED, SCALE = 30, 50, 5, 1_000_000_000
# Bytes of text that are split at once, partial counts that a task holds, cells of a shard, sources of a block.
PIECE, HELD, CELLS, BLOCK = 8 << 20, 300_000, 1 << 20, 256
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``PIECE`` bytes of text; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE, "right"))
        yield batch.slice(at, max(end, at + 1) - at)
        at = max(end, at + 1)


def counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term), and one row with an empty term per group."""
    lang, source, text = (pc.fill_null(batch.column(c), "") for c in ("lang", "source", "text"))
    languages, sources = lang.dictionary_encode(), source.dictionary_encode()
    groups = pc.add(pc.multiply(languages.indices.cast(pa.int64()), len(sources.dictionary)), sources.indices.cast(pa.int64()))
    terms = pc.split_pattern_regex(pc.ascii_lower(text), pattern=_BETWEEN)
    words = pc.list_flatten(terms).dictionary_encode()
    each = pa.table({"doc": pc.list_parent_indices(terms), "term": words.indices}).filter(
        pc.not_equal(pc.take(words.dictionary, words.indices), ""))
    by_doc = each.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    grouped = pa.table({"group": pc.take(groups, by_doc["doc"]), "term": by_doc["term"], "n": by_doc["count_all"]}).group_by(
        ["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    present = pc.unique(groups)
    both = pa.concat_arrays([*grouped["group"].chunks, present])
    zero = pa.array(np.zeros(len(present), np.int64))
    return pa.Table.from_arrays([
        pc.take(languages.dictionary, pc.divide(both, len(sources.dictionary))),
        pc.take(sources.dictionary, pc.subtract(both, pc.multiply(pc.divide(both, len(sources.dictionary)), len(sources.dictionary)))),
        pa.concat_arrays([*pc.take(words.dictionary, grouped["term"]).chunks, pa.array([""] * len(present), pa.string())]),
        pa.concat_arrays([*grouped["n_sum"].chunks, zero]), pa.concat_arrays([*grouped["n_count"].chunks, zero])], schema=_COUNTS)


def merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return found.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for piece in pieces(batch):
            held.append(counted(piece))
            if sum(len(t) for t in held) > HELD:
                held = [merged(held)]
                if len(held[0]) > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held = []
    if held:
        yield from merged(held).to_batches(max_chunksize=50_000)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + ADDED) / total) in whole numbers."""
    rest = counts + ADDED
    found = rest // total
    for _ in range(3):
        rest = rest % total * 1000
        found = found * 1000 + rest // total
    return found + 1


_SHARE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _shard(key: tuple, terms: pa.Table, totals: pa.Table) -> pa.Table:
    """Of the sources of one block: their share of each pair with a later source, and their leading terms."""
    lang, block = key[0].as_py(), key[2].as_py()
    sources = totals.column("source").to_pylist()
    order = sorted(range(len(sources)), key=lambda n: sources[n].encode())
    sources = [sources[n] for n in order]
    sums = totals.column("total").to_numpy()[order]
    kept = sorted(set(terms.column("term").to_pylist()), key=str.encode)
    counts = np.zeros((len(sources), len(kept)), np.int64)
    row = pc.index_in(terms.column("source"), value_set=pa.array(sources, pa.string())).to_numpy()
    column = pc.index_in(terms.column("term"), value_set=pa.array(kept, pa.string())).to_numpy()
    counts[row, column] = terms.column("n").to_numpy()
    added = ADDED * int(totals.column("v")[0].as_py())
    p = shares(counts, (sums + added)[:, None]) if kept else counts
    whole = shares(counts.sum(0), sums.sum() + added) if kept else np.zeros(0, np.int64)
    found: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

    def give(source: str, part: str, items: list[str], values: np.ndarray) -> None:
        found["source"] += [source] * len(items)
        found["part"] += [part] * len(items)
        found["item"] += items
        found["value"] += values.tolist()

    for n in range(block * BLOCK, min((block + 1) * BLOCK, len(sources))):
        give(sources[n], "pair", sources[n + 1:], np.abs(p[n + 1:] - p[n]).sum(1))
        over = np.flatnonzero((counts[n] > 0) & (p[n] > whole))
        best = over[np.argsort(whole[over] - p[n][over], kind="stable")][:RANKS]
        give(sources[n], "term", [kept[t] for t in best], p[n][best] - whole[best])
    return pa.table({"lang": [lang] * len(found["source"]), **found}, schema=_SHARE)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances between sources, and the terms each one overuses."""
    texts = docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    partial = texts.mapInArrow(_partial, "lang string, source string, term string, n long, docs long")
    # One exchange by (lang, term) serves both groupings; tasks have counted before.
    counts = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = staged(counts.withColumn("docs", F.sum("docs").over(W.partitionBy("lang", "term"))).where(
        f"term = '' OR docs >= {LEAST_DOCUMENTS}").select("lang", "source", "term", "n"), "term-counts")
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = counts.where("term <> ''")
    terms = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    languages = staged(groups.groupBy("lang").agg(F.count("*").alias("s")).join(terms, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.expr(f"greatest(1, ceil(coalesce(v, 0) * s / {CELLS}))").alias("shards"),
        F.expr(f"ceil(s / {BLOCK})").alias("blocks")), "languages")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cells = kept.join(languages, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), every("blocks").alias("block"), "source", "term", "n")
    totals = staged(groups.join(languages, "lang").select("lang", "source", "total", "v", "blocks", every("shards").alias("shard")).select(
        "lang", "shard", every("blocks").alias("block"), "source", "total", "v"), "totals")
    key = ["lang", "shard", "block"]
    found = staged(cells.groupBy(*key).cogroup(totals.groupBy(*key)).applyInArrow(
        _shard, "lang string, source string, part string, item string, value long"), "shares")
    half = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    other = half.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = half.unionByName(other).select("*", rank)
    return pairs.unionByName(found.where("part = 'term'").select("*", rank).where(f"rank <= {RANKS}"))
