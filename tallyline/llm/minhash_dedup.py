"""Near-duplicate documents by bottom-k sketches of their shingle sets, confirmed on the full sets.

A document's sketch is the ``SKETCH`` smallest hashes of its set under one hash function. Documents
with equal sets are one class, handled by its smallest id. Two classes at the threshold of 3/4 share
half of the shorter sketch but for a chance below 1e-5 (48 of 64 values are expected, with a standard
deviation of 3.5). Inverted lists of retained values need to hold only each class's rarest values,
so many that two sketches that share half of their values meet in a list; a passage that many
documents share is not among the rarest of a document of which it is the smaller part.

Overlaps are then found in two steps, neither of which writes out the pairs of a list:

* every member of a list is compared with the list's leader, the class whose values most others hold,
  and confirmed links are joined into components;
* members of one list in different components are compared in blocks of ``BLOCK`` members, a block
  pair at a time; blocks inside one component are not compared with each other. At first only each
  member's nearest is confirmed, which joins most of a group. Then all pairs that are left apart are
  compared, each in one of the lists that both are in: members of a pair that shares half of the
  shorter sketch meet again with their full sets, and the linked components leave the task.

The first pairs pass the estimate of the similarity from the union sketch, with some slack, before the
exact count on full sets. Each step drops pairs only, never documents, and has no cap.

Null and empty texts have an empty set and are linked with nothing; rows with a null id are linked with
nothing and kept; repeated rows with one id are one document in links and stay repeated in the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import bloom
from tallyline.llm.components import connected_components
from tallyline.llm.shingles import shingle_sets
from tallyline.llm.store import staged
from tallyline.llm.words import forget_encoders, texts_of

SKETCH = 64
# Share of the union sketch that a candidate has to have: 0.75 less 4.6 standard deviations of the estimate.
LEAST_ESTIMATE = 0.5
BLOCK = 512
BATCH_BYTES = 1 << 20


def _groups(keys: list, texts: Iterator[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    ids, held, size = [], [], 0
    for key, text in zip(keys, texts):
        ids.append(key)
        held.append(text)
        size += len(text)
        if size > BATCH_BYTES:
            yield ids, held
            ids, held, size = [], [], 0
    if ids:
        yield ids, held


def _sketches(width: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            for ids, texts in _groups(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                sets = shingle_sets(texts, width)
                marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()),
                    pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))], schema=schema)
    return run


def _full_sets(width: int, table: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            batch = batch.filter(pa.array(bloom.may_hold(table, batch.column(2).to_numpy())))
            for ids, texts in _groups(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(
                    shingle_sets(texts, width), pa.list_(pa.int64()))], schema=schema)
    return run


def _common(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many values each two rows share; ``values``: those of all rows, one row after another."""
    n = len(sizes)
    found, which, times = np.unique(values, return_inverse=True, return_counts=True)
    keep = times[which] > 1
    owner, column = np.repeat(np.arange(n), sizes)[keep], (np.cumsum(times > 1) - 1)[which[keep]]
    width, shared = int((times > 1).sum()), np.zeros((n, n), np.float32)
    for start in range(0, width, 4096):
        mine = (column >= start) & (column < start + 4096)
        held = np.zeros((n, min(4096, width - start)), np.float32)
        held[owner[mine], column[mine] - start] = 1
        shared += held @ held.T
    return shared


def _pairs_apart(nearest: bool, schema: pa.Schema):
    """Pairs in different components that share half of the shorter sketch, from sorted block pairs.

    ``nearest``: of each member's pairs the one with the largest share, as (a, b). Otherwise the
    members of all pairs, as (value, tile, id, part); a pair counts in the list with the smallest value
    of those that both are in: every such list is compared.
    """
    def of(value: int, tile: int, ids, parts, sketches, sizes, listed, n_listed) -> tuple[np.ndarray, ...]:
        none = (np.empty(0, np.int64),) * len(schema)
        apart = parts[:, None] != parts[None, :]
        if not apart.any():
            return none
        shorter = np.minimum(sizes[:, None], sizes[None, :])
        shared = _common(sketches, sizes)
        fit = apart & (2 * shared >= shorter)
        if nearest:
            share = np.where(fit, shared / shorter, 0)
            i, j = np.arange(len(ids)), share.argmax(1)
            i, j = i[share.max(1) > 0], j[share.max(1) > 0]
        else:
            if fit.any():
                before = listed < value
                fit &= _common(listed[before], np.bincount(np.repeat(np.arange(len(ids)), n_listed)[before], minlength=len(ids))) == 0
            i = np.flatnonzero(fit.any(1))
            return np.full(len(i), value), np.full(len(i), tile), ids[i], parts[i]
        return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])

    return _by_tile(("sketch", "listed"), of, schema)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), column.value_lengths().to_numpy().astype(np.int64)


def _by_tile(lists: tuple[str, ...], of, schema: pa.Schema):
    """``of(value, tile, ids, parts, ...)`` on each run of equal (value, tile) in sorted rows.

    For every name in ``lists`` it gets the run's values, one row after another, and their number per
    row. One run at most is held over the end of a batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def given(rows: pa.Table, bounds: list[int]) -> pa.RecordBatch:
            value, tile, ids, parts = (rows.column(n).to_numpy() for n in ("value", "tile", "id", "part"))
            columns = []
            for name in lists:
                values, sizes = _flat(rows.column(name).combine_chunks())
                columns.append((values, sizes, np.append(0, np.cumsum(sizes))))
            found = [of(value[a], tile[a], ids[a:b], parts[a:b], *[x for v, n, at in columns for x in (v[at[a]:at[b]], n[a:b])])
                     for a, b in zip(bounds, bounds[1:]) if b - a > 1]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *c]), pa.int64())
                                               for c in (list(zip(*found)) or [()] * len(schema))], schema=schema)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            key = np.stack([rows.column(n).to_numpy() for n in ("value", "tile")])
            bounds = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist()]
            if bounds[-1]:
                yield given(rows.slice(0, bounds[-1]), bounds)
            held = rows.slice(bounds[-1])
        if held is not None:
            yield given(held, [0, held.num_rows])
    return run


# Items of full sets that are compared at once; a block pair with more is compared in pieces.
ITEMS = 4_000_000


def _linked_parts(value: int, tile: int, ids, parts, items, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of components that some of the rows link, by the exact similarity of full sets."""
    at = np.append(0, np.cumsum(sizes))
    cuts = [0, *(np.flatnonzero(np.diff(at[1:] // (ITEMS // 2))) + 1).tolist(), len(ids)]
    ranges, found = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b], []
    for n, (a, b) in enumerate(ranges):
        for c, d in ranges[n:]:
            rows = np.unique(np.r_[a:b, c:d])
            both = _common(np.concatenate([items[at[a]:at[b]], items[at[c]:at[d]]][:1 + (c > a)]), sizes[rows]).astype(np.int64)
            union = sizes[rows][:, None] + sizes[rows][None, :] - both
            i, j = np.nonzero(np.triu((100 * both >= 75 * union) & (parts[rows][:, None] != parts[rows][None, :]), 1))
            found.append(np.unique(np.sort(np.stack([parts[rows[i]], parts[rows[j]]], 1), 1), axis=0))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose similarity as the union sketch estimates it is within the slack."""
    both = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a").join(
        sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
    union = both.withColumn("top", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH))
    common = F.size(F.array_intersect("top", F.array_intersect("sa", "sb")))
    return union.where(common >= F.size("top") * F.lit(LEAST_ESTIMATE)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with 100 * intersection >= 75 * union on full sets."""
    a = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    b = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    sizes = pairs.join(a, "a").join(b, "b").select(
        "a", "b", F.size("ia").cast("long").alias("na"), F.size("ib").cast("long").alias("nb"),
        F.size(F.array_intersect("ia", "ib")).cast("long").alias("both"))
    return sizes.where("100 * both >= 75 * (na + nb - both)").select("a", "b")


def _apart(lists: DataFrame, parts: DataFrame, sketches: DataFrame, nearest: bool) -> DataFrame:
    """Rows of ``_pairs_apart`` over lists (value, id, listed) whose members are in several parts."""
    lists = lists.join(parts, "id", "left").select("value", "id", "listed", F.coalesce("component", "id").alias("part"))
    sizes = lists.groupBy("value", "part").agg(F.count("*").alias("in_part"))
    open_lists = sizes.groupBy("value").agg(
        F.count("*").alias("parts"), F.sum(F.when(F.col("in_part") <= BLOCK, F.col("in_part")).otherwise(0)).alias("in_small"))
    open_lists = open_lists.where("parts > 1").drop("parts")
    rows = lists.join(sizes, ["value", "part"]).join(open_lists, "value").join(sketches, "id")
    large = F.col("in_part") > BLOCK
    rows = staged(rows.select(
        "value", "id", "part", "sketch", "listed",
        F.when(large, F.col("part")).otherwise(F.lit(-1).cast("long")).alias("class"),
        F.when(large, F.pmod(F.xxhash64("id"), F.ceil(F.col("in_part") / BLOCK)))
        .otherwise(F.pmod(F.xxhash64("part"), F.greatest(F.lit(1), F.ceil(F.col("in_small") / BLOCK)))).alias("block")), "open-lists")
    blocks = rows.select("value", "class", "block").distinct()
    first = blocks.select("value", F.struct("class", "block").alias("x"))
    second = blocks.select("value", F.struct("class", "block").alias("y"))
    # A block pair inside one part has nothing apart; blocks of small parts are compared with themselves too.
    tiles = first.join(second, "value").where("x <= y AND NOT (x.class = y.class AND x.class <> -1)")
    sides = tiles.select("value", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("side"))
    sides = sides.select("value", F.xxhash64("x", "y").alias("tile"), "side.class", "side.block")
    names = ("a", "b") if nearest else ("value", "tile", "id", "part")
    schema = pa.schema([(name, pa.int64()) for name in names])
    dealt = rows.join(sides, ["value", "class", "block"]).select("value", "tile", "id", "part", "sketch", "listed")
    return dealt.repartition("value", "tile").sortWithinPartitions("value", "tile").mapInArrow(
        _pairs_apart(nearest, schema), ", ".join(f"{name} long" for name in names))


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; component_id: smallest id reachable by links."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("mark", pa.binary()), ("sketch", pa.list_(pa.int64()))])
    sketched = staged(texts.mapInArrow(_sketches(width, schema), "id long, n_shingles long, mark binary, sketch array<long>"),
                      "sketches")
    classes = sketched.where("mark IS NOT NULL AND id IS NOT NULL").groupBy("mark").agg(
        F.min("id").alias("id"), F.min_by("sketch", "id").alias("sketch"))
    classes = staged(classes, "classes")

    # Retained values that several classes hold, the rarest of each class that suffice to meet its partners.
    retained = classes.select("id", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    frequent = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = retained.join(frequent, "value").groupBy("id", "m").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"), F.sum("df").alias("fame"))
    needed = F.col("m") - F.ceil(F.col("m") / 2) + 1  # values beside which less than half is left
    alone = F.col("m") - F.size("held")
    rarest = shared.select("id", "fame", F.explode(F.slice("held", F.lit(1), F.greatest(F.lit(0), needed - alone).cast("int"))).alias("x"))
    lists = staged(rarest.select("id", "fame", "x.value"), "lists")

    # Every member with the leader of its list.
    leaders = lists.groupBy("value").agg(F.max(F.struct("fame", "id")).alias("leader"), F.count("*").alias("n")).where("n > 1")
    stars = lists.join(leaders, "value").where("id <> leader.id").select(
        F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b")).distinct()
    sketches = classes.select("id", "sketch")
    stars = staged(_likely(stars, sketches), "stars")

    # Full sets of classes that are in a list with others; the filter keeps other texts out of the exchange.
    met = staged(lists.join(leaders.select("value"), "value", "left_semi").select("id").distinct(), "met")
    table = bloom.build(met.select(F.xxhash64("id").alias("hash")))
    set_schema = pa.schema([("id", pa.int64()), ("items", pa.list_(pa.int64()))])
    found = texts.where("id IS NOT NULL").select("id", "text", F.xxhash64("id").alias("hash")).mapInArrow(
        _full_sets(width, table, set_schema), "id long, items array<long>")
    sets = staged(found.join(met, "id", "left_semi").dropDuplicates(["id"]), "sets")
    links = staged(_confirmed(stars, sets), "links")

    # Members of one list that are still apart: first with their nearest, then each with each.
    full = lists.join(leaders.select("value"), "value", "left_semi").join(
        lists.groupBy("id").agg(F.collect_list("value").alias("listed")), "id").select("value", "id", "listed")
    full = staged(full, "full-lists")
    pairs = _apart(full, connected_components(links), sketches, nearest=True).distinct()
    links = staged(links.unionByName(_confirmed(_likely(pairs, sketches), sets)), "links")
    members = _apart(full, connected_components(links), sketches, nearest=False).join(sets, "id")
    linked = members.repartition("value", "tile").sortWithinPartitions("value", "tile").mapInArrow(
        _by_tile(("items",), _linked_parts, pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long")
    links = links.unionByName(linked)

    parts = connected_components(links)
    reached = classes.select("mark", "id").join(parts, "id", "left").select(
        "mark", F.coalesce("component", "id").alias("component"))
    rows = sketched.select("id", "n_shingles", "mark").join(reached, "mark", "left")
    component = F.coalesce("component", "id")
    return rows.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                       F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def keep_first_of_group(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with all their columns.

    Of repeated rows with one id all stay or all go.
    """
    found = near_duplicates(docs, width, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(found, docs[id_col] == found["_gone"], "left_anti")
