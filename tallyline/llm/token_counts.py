"""Token counts: pieces are counted once per distinct pre-token and summed per document.

A pre-token is a white-space separated word. Each task turns a block of documents into postings
(document in the block, frequency) per distinct word. The postings are dealt by the word's hash, a
compressed row per block and deal, so that all occurrences of a word meet in one task. There its
pieces are counted once and joined to its postings; counts times frequencies are summed into one
array per block. A second, small exchange adds the arrays of a block. A frequent word has one posting
list per block, however often it occurs. No ids are kept.

Null and empty texts have no tokens. Rows are counted one by one, so repeated rows and null keys stay.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.words import CACHED_WORDS, texts_of, word_ids

# A block is closed at this size; its documents have 16-bit numbers.
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 60_000
# Sums are given out when a task holds this many.
HELD_SUMS = 4_000_000

_ROWS = pa.schema([("deal", pa.int32()), ("block", pa.int64()), ("names", pa.bool_()), ("data", pa.binary())])
_ROW = "deal int, block long, names boolean, data binary"


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays after one another, each with its length, compressed."""
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return zlib.compress(b"".join([struct.pack(f"<{len(parts)}Q", *map(len, parts)), *parts]), 1)


def _unpacked(data: bytes, n: int) -> list[bytes]:
    data, parts = zlib.decompress(data), []
    at = 8 * n
    for size in struct.unpack_from(f"<{n}Q", data):
        parts.append(data[at:at + size])
        at += size
    return parts


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _block_rows(block: int, ids: list, texts: list[bytes], by_word: bool, deals: int) -> pa.RecordBatch:
    """A row of postings per deal, and one with the documents' keys and sizes."""
    numbers = _Numbers()
    words, where, times = [], [], []
    for n, text in enumerate(texts):
        of_doc = Counter(text.split() if by_word else [text])
        words.append(np.fromiter(map(numbers.__getitem__, of_doc), np.int64, len(of_doc)))
        times.append(np.fromiter(of_doc.values(), np.uint32, len(of_doc)))
        where.append(np.full(len(of_doc), n, np.uint16))
    word, doc, freq = np.concatenate(words), np.concatenate(where), np.concatenate(times)
    names = list(numbers)
    deal_of = np.fromiter(map(zlib.crc32, names), np.uint32, len(names)) % deals
    # Words by deal, postings by word in that order and by document within it.
    order = np.argsort(deal_of, kind="stable")
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    by_rank = np.argsort(rank[word], kind="stable")
    doc, freq, rank = doc[by_rank], freq[by_rank], rank[word][by_rank]
    starts = np.searchsorted(rank, np.arange(len(names) + 1))
    bounds = np.searchsorted(deal_of[order], np.arange(deals + 1))
    rows = []
    for deal in range(deals):
        a, b = bounds[deal], bounds[deal + 1]
        if a < b:
            mine, part = [names[i] for i in order[a:b]], slice(starts[a], starts[b])
            rows.append((deal, block, False, _packed(
                np.array([len(w) for w in mine], "<u4"), b"".join(mine), np.diff(starts[a:b + 1]).astype("<u4"), doc[part], freq[part])))
    directory = _packed(np.array([k is None for k in ids], bool), np.array([k or 0 for k in ids], "<i8"),
                        np.array([len(t) for t in texts], "<i8"))
    rows.append((block % deals, block, True, directory))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS)


def _blocks(path: str, deals: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word = word_ids(path).by_word
        first, n = TaskContext.get().partitionId() << 32, 0
        ids, texts, held = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids.append(key)
                texts.append(text)
                held += len(text)
                if held >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                    yield _block_rows(first + n, ids, texts, by_word, deals)
                    ids, texts, held, n = [], [], 0, n + 1
        if ids:
            yield _block_rows(first + n, ids, texts, by_word, deals)
    return run


def _sums(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        width = encoder.dtype.itemsize
        sums: dict[int, np.ndarray] = {}
        counts: dict[bytes, int] = {}
        held = 0

        def given(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(_ROWS)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ROWS.types)], schema=_ROWS)

        def summed() -> pa.RecordBatch:
            return given([(0, block, False, _packed(s)) for block, s in sums.items()])

        for batch in batches:
            for deal, block, names, data in zip(*[c.to_pylist() for c in batch.columns]):
                if names:
                    yield given([(deal, block, True, data)])
                    continue
                sizes, words, lengths, docs, freqs = _unpacked(data, 5)
                ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
                pieces = np.empty(len(ends), np.int64)
                at = 0
                for i, end in enumerate(ends):
                    word = words[at:end]
                    at = end
                    n = counts.get(word)
                    if n is None:
                        if len(counts) >= CACHED_WORDS:
                            counts.clear()
                        n = counts[word] = len(encoder.encode(word)) // width
                    pieces[i] = n
                gain = np.frombuffer(freqs, "<u4") * np.repeat(pieces, np.frombuffer(lengths, "<u4"))
                add = np.bincount(np.frombuffer(docs, "<u2"), gain).astype(np.int64)
                had = sums.get(block, np.empty(0, np.int64))
                if len(had) < len(add):
                    had, add = add, had
                    held += len(had) - len(add)
                had[:len(add)] += add
                sums[block] = had
                if held > HELD_SUMS:
                    yield summed()
                    sums, held = {}, 0
        yield summed()
    return run


def _documents(key: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        missing, ids, sizes = _unpacked(rows["data"][rows["names"]].iloc[0], 3)
        total = np.zeros(len(missing), np.int64)
        for data in rows["data"][~rows["names"]]:
            part = np.frombuffer(_unpacked(data, 1)[0], np.int64)
            total[:len(part)] += part
        keys = pd.array(np.frombuffer(ids, "<i8"), "Int64")
        keys[np.frombuffer(missing, bool)] = pd.NA
        return pd.DataFrame({key: keys, "n_bytes": np.frombuffer(sizes, "<i8"), "n_tokens": total})
    return run


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every document, by the vocabulary file ``tokenizer``."""
    pairs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Several deals per task, so that tasks get about equal shares.
    deals = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = pairs.mapInArrow(_blocks(tokenizer, deals), _ROW)
    sums = postings.repartition("deal").mapInArrow(_sums(tokenizer), _ROW)
    return sums.groupBy("block").applyInPandas(_documents(id_col), f"{id_col} long, n_bytes long, n_tokens long")
