"""Near-duplicate vectors: sign hashing by random hyperplanes, exact cosines, connected components.

Equal vectors are one class. Each class gets a code of ``bits`` signs in each of several tables; the
bits follow the number of classes, so that a bucket of unrelated vectors stays small, and the tables
are as many as a pair at the least cosine needs to meet in one of them with probability ``RECALL``.
Members of a bucket are compared in blocks of at most ``BLOCK`` by one matrix product in double
precision. A larger bucket is cut into blocks and every pair of its blocks is one piece of work, so no
bucket is capped and none is gathered in one task. A pair counts in the first table where its codes
agree. Per block pair only each vector's number of links and one edge to the smallest vector of its
component among the block pair's links leave the task, never the pairs.

Vectors that are null, zero or hold null or non-finite components are linked with nothing. Vectors of
different lengths are not compared. Rows with a null id keep their row and are linked with nothing;
repeated rows with one id are one vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.store import staged

RECALL = 0.997
BLOCK = 1024
# Unrelated vectors that a bucket holds on average, up to a factor of two.
BUCKET = 64
SEED = 20


def plan(n: int, least: float) -> tuple[int, int]:
    """Signs per code and number of tables for n vectors."""
    bits = max(6, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 6)
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def _codes(bits: int, tables: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            ids, copies = batch.column("id").to_pylist(), batch.column("copies").to_pylist()
            vectors = batch.column("vector")
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                x = np.array(vectors.take(pa.array(mine)).to_pylist(), np.float64)
                if size not in planes:
                    planes[size] = np.random.default_rng(SEED).standard_normal((size, bits * tables))
                signs = (x @ planes[size] > 0).reshape(len(mine), tables, bits)
                codes = (signs @ weights).astype(np.int32)
                # Scaled before the norm, so that squares neither overflow nor vanish.
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in mine], pa.int64()), pa.array([copies[i] for i in mine], pa.int64()),
                    pa.array([int(size)] * len(mine), pa.int32()),
                    pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(codes), pa.list_(pa.int32()))], schema=schema)
    return run


def _merged(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root``, the least member of each member's component, after the links (i, j) are added."""
    while True:
        i, j = root[i], root[j]
        apart = i != j
        if not apart.any():
            return root
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while not np.array_equal(further := root[root], root):
            root = further


def _compared(left: np.ndarray, vectors: np.ndarray, codes: np.ndarray, table: int, copies: np.ndarray, ids: np.ndarray,
              least: float, cut: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links per member (weighed by copies) and the smallest vector of its component, in one block pair.

    ``left``: whether a member is of the first block; within one block (not ``cut``) all are. The
    components are those of all links in the block pair, so one edge per member to its root spans them.
    """
    order = np.argsort(ids)
    rank = np.argsort(order)
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    rows = np.flatnonzero(left)
    cols = np.flatnonzero(~left) if cut else rows
    for start in range(0, len(rows), 256):
        some = rows[start:start + 256]
        i, j = np.nonzero(vectors[some] @ vectors[cols].T >= least)
        i, j = some[i], cols[j]
        if not cut:
            i, j = i[i < j], j[i < j]
        root = _merged(root, rank[i], rank[j])
        if table:
            new = np.ones(len(i), bool)
            for t in range(table):
                new &= codes[i, t] != codes[j, t]
            i, j = i[new], j[new]
        links += np.bincount(i, copies[j], len(ids)).astype(np.int64) + np.bincount(j, copies[i], len(ids)).astype(np.int64)
    return links, ids[order][root[rank]]


def _links(least: float, schema: pa.Schema):
    """Runs of equal keys in sorted rows are block pairs; one at most is held over a batch's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def of(part: pa.Table) -> tuple:
            vectors = np.frombuffer(b"".join(part.column("unit").to_pylist())).reshape(part.num_rows, -1)
            codes = np.array(part.column("codes").to_pylist(), np.int32)
            table, first, second = (part.column(n)[0].as_py() for n in ("table", "first", "second"))
            ids = part.column("id").to_numpy()
            links, root = _compared(part.column("own").to_numpy() == first, vectors, codes, table,
                                    part.column("copies").to_numpy(), ids, least, first != second)
            linked = (root < ids) | (links > 0)
            return ids[linked], links[linked], root[linked]

        def given(parts: list[tuple]) -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            key = np.stack([rows.column(n).to_numpy().astype(np.int64) for n in ("size", "table", "code", "first", "second")])
            ends = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            bounds = [0, *ends.tolist()]
            yield given([of(rows.slice(a, b - a)) for a, b in zip(bounds, bounds[1:]) if b - a > 1])
            held = rows.slice(bounds[-1]).combine_chunks()
        if held is not None and held.num_rows > 1:
            yield given([of(held)])
    return run


def near_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row; links: found pairs with a cosine of at least ``least``."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    usable = F.col("id").isNotNull() & F.coalesce(sound, F.lit(False))
    # Both zeros are one value; + 0.0 makes them alike before vectors are grouped.
    sane = rows.where(usable).select("id", F.transform(v, lambda x: x + F.lit(0.0)).alias("vector"))
    marked = sane.dropDuplicates(["id"]).withColumn("mark", F.sha2(F.concat_ws(",", F.transform("vector", lambda x: x.cast("string"))), 256))
    marked = staged(marked, "vectors")
    classes = marked.groupBy("mark").agg(F.min("id").alias("id"), F.min_by("vector", "id").alias("vector"), F.count("*").alias("copies"))
    classes = staged(classes, "vector-classes")
    bits, tables = plan(classes.count(), least)

    code_schema = pa.schema([("id", pa.int64()), ("copies", pa.int64()), ("size", pa.int32()), ("unit", pa.binary()),
                             ("codes", pa.list_(pa.int32()))])
    coded = staged(classes.select("id", "copies", "vector").mapInArrow(
        _codes(bits, tables, code_schema), "id long, copies long, size int, unit binary, codes array<int>"), "codes")
    placed = coded.select("*", F.posexplode("codes").alias("table", "code"))
    keys = ["size", "table", "code"]
    large = coded.select("size", F.posexplode("codes").alias("table", "code")).groupBy(keys).count().where(
        F.col("count") > BLOCK).select(*keys, F.ceil(F.col("count") / BLOCK).alias("blocks"))
    cut = placed.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long"))).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        *keys, F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "id", "copies", "unit", "codes")
    dealt = [*keys, "first", "second"]
    link_schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    found = staged(pairs.repartition(*dealt).sortWithinPartitions(*dealt).mapInArrow(
        _links(least, link_schema), "id long, links long, root long"), "vector-links")

    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    reached = classes.select("mark", "id", "copies").join(counts, "id", "left").join(parts, "id", "left").select(
        "mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"))
    linked = marked.select("id", "mark").join(reached, "mark").select("id", "n_links", "component")
    component = F.coalesce("component", "id")
    return rows.select("id").join(linked, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
