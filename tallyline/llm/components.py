"""Connected components of an edge table, by contraction.

Each round every vertex moves to the least vertex of its neighbourhood and the edges follow; a
neighbourhood is a minimum, which is combined before the exchange, so a vertex with very many edges is
no burden. Least is by number in even rounds, which ends stars at once, and by a hash in odd rounds,
which shortens chains by a constant factor whatever their numbering. Nothing but edge tables is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.store import staged


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (long columns a, b); component: its smallest id."""
    edges, moves = staged(_ordered(edges), "edges"), []
    while not edges.isEmpty():
        turn = len(moves)
        rank = (lambda c: c) if turn % 2 == 0 else (lambda c: F.xxhash64(c, F.lit(turn)))
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionByName(
            edges.select(F.col("b").alias("v"), F.col("a").alias("n")))
        least = ends.groupBy("v").agg(F.min(F.struct(rank(F.col("n")).alias("rank"), "n")).alias("least"))
        moved = staged(least.select("v", F.when(rank(F.col("v")) < F.col("least.rank"), F.col("v"))
                                    .otherwise(F.col("least.n")).alias("to")), "moves")
        moves.append(moved)
        edges = edges.join(moved.select(F.col("v").alias("a"), F.col("to").alias("p")), "a").join(
            moved.select(F.col("v").alias("b"), F.col("to").alias("q")), "b")
        edges = staged(_ordered(edges.select(F.col("p").alias("a"), F.col("q").alias("b"))), "edges")
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = moves[0].select(F.col("v").alias("id"), "to")
    for moved in moves[1:]:
        roots = roots.join(moved.select(F.col("v").alias("to"), F.col("to").alias("next")), "to", "left").select(
            "id", F.coalesce("next", "to").alias("to"))
    roots = staged(roots, "roots")
    least = roots.groupBy("to").agg(F.min("id").alias("component"))
    return roots.join(least, "to").select("id", "component")
