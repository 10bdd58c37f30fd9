"""Exact top-k by inner product: sorted lists read in order, score bounds, no random access before the end.

Candidates are dealt into blocks, queries into groups, and every (block, group) is one piece of work.
A block has one list per component, sorted; a query reads it from the largest value where its own
component is positive and from the smallest where it is negative. After each depth of ``DEPTHS`` a
candidate's score lies between what was read of it plus the least that the unread components can give
and the same plus the most, which is at most the value last read of each list. Reading stops for a
query when a candidate that no list has shown cannot reach the k-th lower bound and few candidates
still can; their final scores are then resolved. At full depth both bounds are the score. Queries of a
group that read in step share one matrix product per bound. The first block's k-th scores are lower
bounds for all other blocks. Each piece hands on k rows per query at most.

Values are floor(scale * x) in double precision, so that scores are exact integers. Vectors that are
null or hold null or non-finite components, and rows with a null id, take no part; an empty vector
scores 0 with empty ones; vectors of different lengths are not compared. Of repeated rows with one id
one takes part. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyline.llm.store import staged

BLOCK, GROUP, STEP = 4096, 2048, 256
# Shares of each list that have been read when bounds are taken.
DEPTHS = (0.75, 0.9, 0.95)
# Candidates that may be left, as a share of the block, when final scores are resolved one by one.
FEW = 0.05


def bounded_scores(block: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the candidates that may be among the best k, and their scores.

    ``floors``: scores that k candidates elsewhere reach already (-inf if unknown). ``own``: the
    query's own row in the block, or -1.
    """
    n, found = len(block), [(np.empty(0, np.int64), np.empty(0))] * len(queries)
    if not n:
        return found
    lists = np.sort(block, axis=0)  # one per component, ascending
    least, most = lists[0], lists[-1]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    open_queries = np.arange(len(queries))
    for depth in (*DEPTHS, 1.0):
        q = open_queries
        if not len(q):
            break
        if depth == 1.0:
            scores = queries[q] @ block.T
            for row, at in enumerate(q):
                found[at] = _kept(scores[row], max(floors[at], _kth(scores[row], k + (own[at] >= 0))), own[at])
            break
        read = max(1, int(depth * n))
        high, low = lists[n - read], lists[read - 1]  # the values last read from either end
        shown_high, shown_low = block >= high, block <= low
        # Over the values last read: the most an unread component gives is in the constant term.
        upper = up[q] @ np.where(shown_high, block - high, 0).T + down[q] @ np.where(shown_low, block - low, 0).T
        outside = up[q] @ high + down[q] @ low
        upper += outside[:, None]
        lower = up[q] @ np.where(shown_high, block - least, 0).T + down[q] @ np.where(shown_low, block - most, 0).T
        lower += (up[q] @ least + down[q] @ most)[:, None]
        left = []
        for row, at in enumerate(q):
            floor = max(floors[at], _kth(lower[row], k + (own[at] >= 0)))
            may = np.flatnonzero(upper[row] >= floor)
            if outside[row] < floor and len(may) <= max(k, FEW * n):
                scores = block[may] @ queries[at]
                hit, value = _kept(scores, max(floors[at], _kth(scores, k + (own[at] >= 0))), -1)
                mine = may[hit] != own[at]
                found[at] = may[hit][mine], value[mine]
            else:
                left.append(at)
        open_queries = np.array(left, np.int64)
    return found


def _kth(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def _kept(scores: np.ndarray, floor: float, own: int) -> tuple[np.ndarray, np.ndarray]:
    hit = np.flatnonzero(scores >= floor)
    hit = hit[hit != own]
    return hit, scores[hit]


def _best(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({"query": [], "id": [], "score": []}, dtype="int64")
        ids = candidates["id"].to_numpy()
        order = np.argsort(ids)
        ids, block = ids[order], np.stack(candidates["values"].to_list()).astype(np.float64)[order]
        wanted, x = queries["id"].to_numpy(), np.stack(queries["values"].to_list()).astype(np.float64)
        if max(np.abs(block).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(block.shape[1], 1) < 2 ** 22:
            block, x = block.astype(np.float32), x.astype(np.float32)  # sums stay exact
        floors = queries["floor"].fillna(-np.inf).to_numpy(float)
        place = np.searchsorted(ids, wanted)
        own = np.where((place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == wanted), place, -1)
        rows = []
        for start in range(0, len(wanted), STEP):
            part = slice(start, start + STEP)
            for query, (hit, scores) in zip(wanted[part], bounded_scores(block, x[part], floors[part], k, own[part])):
                top = np.lexsort((ids[hit], -scores))[:k]
                rows.append((np.full(len(top), query), ids[hit][top], scores[top].astype(np.int64)))
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query", "id", "score"), zip(*rows))})
    return run


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): each query's k best other rows. ``is_query`` is a condition on ``id``."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale)).alias("values"))
    rows = staged(rows.dropDuplicates(["id"]).withColumn("size", F.size("values")), "search-rows")
    wanted = rows.where(is_query)
    blocks = max(1, -(-rows.count() // BLOCK))
    groups = max(1, -(-wanted.count() // GROUP))
    candidates = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = wanted.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int"))
    keys = ["size", "block", "group"]

    def searched(blocks_of_queries: DataFrame, some: Column) -> DataFrame:
        renamed = blocks_of_queries.toDF(*blocks_of_queries.columns)  # both sides come from the same rows
        return candidates.where(some).groupBy(*keys).cogroup(renamed.groupBy(*keys)).applyInPandas(
            _best(k), "query long, id long, score long")

    first = staged(searched(dealt.withColumns({"block": F.lit(0).cast("long"), "floor": F.lit(None).cast("double")}),
                            F.col("block") == 0), "search-first")
    if blocks == 1:
        found = first
    else:
        # The k-th score in the first block, where it has k candidates.
        floors = _ranked(first, k).where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").cast("double").alias("floor"))
        others = dealt.join(floors, "id", "left").withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(blocks - 1).cast("long"))))
        found = first.unionByName(searched(others, F.col("block") > 0))
    return _ranked(found, k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                                    F.col("id").alias(id_col), "score")
