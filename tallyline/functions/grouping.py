"""Per-key selections that stay distributed when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

COPIES_PER_CHUNK = 100_000
# A hot key holds at least so many rows and one in so many of all rows. The sketch that finds hot keys follows so
# many candidates, and errs by less than one in 4,000 of all rows.
HOT_ROWS, HOT_SHARE, FOLLOWED = 100_000, 1000, 10_000


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys are equal to each other.

    Written as ``row_number() = 1`` so that Catalyst adds a rank limit before the shuffle: each
    map task sends at most one row per key, whatever the size of the key.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def hot_keys(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that hold many of the rows, ``HOT_SHARE`` at most, from a sketch per task."""
    found = df.select(F.xxhash64(*keys).alias("_short")).agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(_short, {HOT_SHARE}, {FOLLOWED})").alias("top")).first()
    least = max(HOT_ROWS, found["rows"] / HOT_SHARE)
    return [top["item"] for top in found["top"] or [] if top["count"] >= least]


def mark_rest(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """All rows; ``out`` is false for the first row of each key in ``order`` and true for the others.

    Every row is exchanged once, to its key. Rows of hot keys, and only they, are found by ``keep_first``
    and ``subtract_copies`` instead, which bring no key whole into one task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    hot = hot_keys(df, keys)
    is_hot = F.xxhash64(*keys).isin(hot)
    cold = df.where(~is_hot) if hot else df
    marked = cold.withColumn("_rank", rank).withColumn(out, F.col("_rank") > 1).drop("_rank")
    if not hot:
        return marked
    many = df.where(is_hot)
    first = keep_first(many, keys, order)
    rest = subtract_copies(many, first)
    return marked.unionByName(first.withColumn(out, F.lit(False))).unionByName(rest.withColumn(out, F.lit(True)))


def subtract_copies(df: DataFrame, taken: DataFrame) -> DataFrame:
    """Multiset difference: every row of ``df`` except one copy per row of ``taken``.

    Grouped on the whole row after a map-side sum, so neither a hot key with different rows nor
    a row with very many copies lands in one task. The rows of such a row, and only they, are
    re-created in bounded chunks that are spread over the cluster.
    """
    columns = df.columns
    signed = df.withColumn("_n", F.lit(1)).unionByName(taken.select(columns).withColumn("_n", F.lit(-1)))
    left = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n > 0")
    few = left.where(F.col("_n") <= COPIES_PER_CHUNK).withColumn("_copies", F.col("_n"))
    many = left.where(F.col("_n") > COPIES_PER_CHUNK)
    last_chunk = ((F.col("_n") - 1) / COPIES_PER_CHUNK).cast("bigint")
    chunks = many.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    copies = F.least(F.lit(COPIES_PER_CHUNK).cast("bigint"), F.col("_n") - F.col("_chunk") * COPIES_PER_CHUNK)
    spread = chunks.repartition(*columns, "_chunk").withColumn("_copies", copies)
    every = few.select(*columns, "_copies").unionByName(spread.select(*columns, "_copies"))
    one = F.lit(1).cast("bigint")
    return every.withColumn("_copy", F.explode(F.sequence(one, F.col("_copies")))).select(columns)


def weighted_mode(df: DataFrame, keys: list[str], value: str, weight: Column, out: str) -> DataFrame:
    """Most frequent ``value`` per key; ties go to the lowest value.

    Two partial aggregations, (key, value) then key: a hot key is reduced to its distinct values
    before the first shuffle and spread over (key, value) in it.
    """
    counted = df.groupBy(*keys, value).agg(F.sum(weight).alias("_n"))
    best = F.min(F.struct(-F.col("_n"), F.col(value).alias("_value")))  # carries the value once
    return counted.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best._value").alias(out))
