"""Union of the two exports and removal of repeated lines with a source priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.grouping import keep_first, mark_rest, subtract_copies
from tallyline.schemas import DUPLICATE

# Compared as raw text, before any cleaning; null equals null.
LINE_KEYS = ["invoice_no", "product_code", "quantity"]
_OTHER_COLUMNS = ["invoice_date", "description", "unit_price", "customer_id", "country"]


def combine_sources(source1: DataFrame, source2: DataFrame) -> DataFrame:
    """Both exports in one table; the second one has priority over the first."""
    return source2.withColumn("source_priority", F.lit(0)).unionByName(
        source1.withColumn("source_priority", F.lit(1))
    )


def line_order(lines: DataFrame) -> list[Column]:
    """Priority, then the place in the file where it is known, then every other column.

    The order covers the whole row, so the first line of a key is the same on every run.
    """
    place = [F.col("line_order")] if "line_order" in lines.columns else []
    return [F.col("source_priority"), *place, *[F.col(c).asc_nulls_last() for c in _OTHER_COLUMNS]]


def unique_lines(lines: DataFrame) -> DataFrame:
    """The first line per (invoice, product code, quantity)."""
    return keep_first(lines, LINE_KEYS, line_order(lines))


def marked_lines(lines: DataFrame) -> DataFrame:
    """All lines; ``duplicate`` is false for those of ``unique_lines`` and true for the others."""
    return mark_rest(lines, LINE_KEYS, line_order(lines), "duplicate")


def duplicate_lines(lines: DataFrame, unique: DataFrame | None = None) -> DataFrame:
    """All other lines, with the reject reason."""
    unique = unique_lines(lines) if unique is None else unique
    return with_duplicate_reason(subtract_copies(lines, unique))


def with_duplicate_reason(duplicates: DataFrame) -> DataFrame:
    return duplicates.withColumn("rejection_reason", F.lit(DUPLICATE))


def dedup_counts(lines: DataFrame) -> DataFrame:
    """Lines before, removed and kept, from one pass over the key columns."""
    per_key = lines.groupBy(*LINE_KEYS).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines_before"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("lines_removed"),
        F.count("*").alias("lines_unique"),
    )
