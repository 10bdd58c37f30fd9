"""Global positions and ranks without pulling all rows into one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyline.session import stage


def running_total(df: DataFrame, order: list[Column], weight: str, before: str, total: str) -> DataFrame:
    """Add the ``weight`` of all rows strictly before each row in a global total order, and of all.

    Rows are range partitioned on ``order`` and staged with their partition number, so both uses
    below see the same ranges. Only one row per range is summed in a single task.
    """
    ranged = stage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(before, F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .withColumn(total, sums.agg(F.sum("_sum").alias("_all")).scalar())
        .drop("_range", "_offset")
    )


def percent_rank_desc(df: DataFrame, value: str, out: str = "percent_rank") -> DataFrame:
    """``percent_rank() over (order by value desc)`` as a table of (value, rank).

    Equal values share a rank, so ranks are computed once per distinct value.
    """
    freq = df.groupBy(value).agg(F.count("*").alias("_n"))
    ranked = running_total(freq, [F.col(value).desc()], "_n", "_before", "_all")
    rank = F.try_divide("_before", (F.col("_all") - 1).cast("double"))
    return ranked.select(value, F.coalesce(rank, F.lit(0.0)).alias(out))


def top_fraction_cut(df: DataFrame, value: str, fraction: float) -> DataFrame:
    """One row: the lowest ``value`` whose descending percent rank is within ``fraction``."""
    return percent_rank_desc(df, value, "_rank").where(F.col("_rank") <= fraction).agg(
        F.min(value).alias("cut")
    )


def number_rows(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """0-based position of each row in a global total order."""
    return running_total(df.withColumn("_one", F.lit(1)), order, "_one", out, "_all").drop("_one", "_all")
