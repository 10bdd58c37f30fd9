"""Packing of token sequences into windows of bounded length, with a bounded number of open windows.

Each task reads its documents once. What a document has beyond whole windows is placed in the open
window where it fits best; if none has room, a new one is opened, and if as many are open as allowed,
the fullest is given out first. Windows still open at the end of a partition are the leftovers: whole
leftover windows are packed into each other by the same rule in groups of ``MERGED`` partitions, and
so on until one group is left, so that only ``open_windows`` windows of all data stay partly empty.

Null and empty texts are the end id alone. Rows are packed one by one, so repeated rows and null keys
stay. Very long documents fill whole windows and a rest. Of the input only key and text are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.store import staged
from tallyline.llm.words import end_id_added, gathered, word_ids

# Partitions whose leftovers are merged in one task of a round.
MERGED = 16
BATCH_BYTES = 4 << 20


class OpenWindows:
    """Best-fit over at most ``most`` open windows of ``size``. Windows are numbered as opened."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.rooms: list[tuple[int, int]] = []  # (room, window), ascending
        self.items: dict[int, list] = {}
        self.opened = 0

    def place(self, length: int, item) -> tuple[int, list] | None:
        """Put an item in a window; the window it made give way or that is full now, with its items."""
        at, out = bisect_left(self.rooms, (length, -1)), None
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) == self.most:
                out = self._closed(self.rooms.pop(0)[1])
            room, window = self.size, self.opened
            self.items[window] = []
            self.opened += 1
        self.items[window].append((self.size - room, item))
        if room == length:
            return self._closed(window)  # never together with one that gave way: then room is the whole size
        insort(self.rooms, (room - length, window))
        return out

    def _closed(self, window: int) -> tuple[int, list]:
        return window, self.items.pop(window)

    def rest(self) -> list[tuple[int, list]]:
        return [self._closed(w) for _, w in self.rooms]


_PIECES = [("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long"), ("window", "long"),
           ("offset", "long"), ("used", "long"), ("closed", "boolean")]


def _pack(path: str, end_id: int, size: int, most: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = word_ids(path), TaskContext.get().partitionId() << 32
        windows, rows, held = OpenWindows(size, most), [], 0

        def given(window: int, items: list, closed: bool) -> None:
            used = items[-1][0] + items[-1][1][2]
            rows.extend((*item, first + window, offset, used, closed) for offset, item in items)

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in gathered(batches):
            for key, ids in zip(batch.column(0).to_pylist(), encoder.each(batch.column(1))):
                ids = end_id_added(ids, end_id)
                data, n = ids.tobytes(), len(ids)
                for start in range(0, n, size):
                    length = min(size, n - start)
                    item = (key, start, length, data[4 * start:4 * (start + length)], n)
                    if length == size:
                        given(windows.opened, [(0, item)], True)
                        windows.opened += 1
                    elif out := windows.place(length, item):
                        given(*out, True)
                held += len(data)
                if held > BATCH_BYTES:
                    yield batch_of()
                    rows.clear()
                    held = 0
        for window, items in windows.rest():
            given(window, items, False)
        yield batch_of()
    return run


def _merge(size: int, most: int, shift: int):
    """Leftover windows of one group, fullest first, packed whole; their new window and place in it."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        windows, out = OpenWindows(size, most), []
        # A number no partition's own windows reach: the round and the group, then a running number.
        first = shift << 58 | int(rows["group"].iloc[0]) << 32

        def given(window: int, items: list, closed: bool) -> None:
            used = items[-1][0] + items[-1][1][1]
            out.extend((old, first + window, offset, used, closed) for offset, (old, _) in items)

        for old, used in rows.sort_values(["used", "window"], ascending=[False, True])[["window", "used"]].itertuples(index=False):
            if closed := windows.place(int(used), (int(old), int(used))):
                given(*closed, True)
        for window, items in windows.rest():
            given(window, items, False)
        return pd.DataFrame(out, columns=["window", "new_window", "base", "new_used", "new_closed"])
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, open_windows: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    ``ids``: the piece's ids as little-endian unsigned 32-bit integers. Every id of a document, and
    ``end_id`` after it, is in exactly one piece; the pieces of a sequence leave no gap from offset 0.
    """
    types = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [(id_col, "long"), *_PIECES]
    schema = pa.schema([(n, types[t]) for n, t in fields])
    pairs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = staged(pairs.mapInArrow(_pack(tokenizer, end_id, size, open_windows, schema),
                                     ", ".join(f"`{n}` {t}" for n, t in fields)), "pieces")

    left = pieces.where("NOT closed").select("window", "used", F.shiftright("window", 32).alias("group")).distinct()
    left = left.withColumn("old", F.col("window")).withColumn("base", F.lit(0).cast("long"))
    done, shift = [], 0
    # Each round has a MERGED-th of the groups of the one before.
    groups = (pieces.agg(F.max(F.shiftright("window", 32))).first()[0] or 0) + 1
    while True:
        shift += 1
        groups = -(-groups // MERGED)
        left = left.withColumn("group", F.floor(F.col("group") / MERGED))
        moved = left.select("group", "window", "used").distinct().groupBy("group").applyInPandas(
            _merge(size, open_windows, shift), "window long, new_window long, base long, new_used long, new_closed boolean")
        left = staged(left.join(moved.withColumnRenamed("base", "more"), "window").select(
            "old", F.col("new_window").alias("window"), (F.col("base") + F.col("more")).alias("base"),
            F.col("new_used").alias("used"), "group", "new_closed"), "leftovers")
        final = F.lit(True) if groups == 1 else F.col("new_closed")
        done.append(left.where(final).select(F.col("old").alias("window"), F.col("window").alias("sequence_id"), "base"))
        if groups == 1:
            break
        left = left.where("NOT new_closed").drop("new_closed")
    placed = done[0]
    for part in done[1:]:
        placed = placed.unionByName(part)
    columns = [id_col, "start", "length", "ids", "doc_tokens"]
    whole = pieces.where("closed").select(*columns, F.col("window").alias("sequence_id"), "offset")
    return whole.unionByName(pieces.where("NOT closed").join(placed, "window").select(
        *columns, "sequence_id", (F.col("offset") + F.col("base")).alias("offset")))
