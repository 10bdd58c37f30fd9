"""Fact tables: invoice lines and the day x product x country rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyline.functions import dates
from tallyline.functions.grouping import keep_first
from tallyline.functions.numbers import number_text
from tallyline.schemas import DAILY_KEYS, FACT_TRANSACTIONS, RETURN, SALE
from tallyline.session import stage

# So many short hashes of repeated rows are sent to every task; with more, all rows are exchanged.
FEW_REPEATED = 100_000


def row_hash() -> Column:
    """SHA-256 of the business key. Whole quantities are always written without a fraction."""
    parts = [F.col("invoice_no"), F.col("product_code"), number_text(F.col("quantity")),
             dates.iso_text_utc(F.col("invoice_ts")), F.col("source")]
    return F.sha2(F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in parts]), 256)


def hashed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("source_row_hash", row_hash())


def fact_transactions(lines: DataFrame, also: list[Column] | None = None) -> DataFrame:
    """Typed fact projection of accepted lines, and columns kept beside it. Quantities are cut to whole numbers
    here, after the revenue was computed from the full value. Lines whose values do not fit were rejected before."""
    source = {"transaction_date": "invoice_ts"}
    typed = hashed(lines)
    return typed.select(
        *[F.col(source.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in FACT_TRANSACTIONS], *also or [])


def _repeated(facts: DataFrame) -> tuple[DataFrame, int]:
    """Short hashes that occur more than once and their number, which is only counted up to one too many."""
    counted = facts.groupBy(F.xxhash64("source_row_hash").alias("_short")).agg(F.count("*").alias("_n"))
    repeated = stage(counted.where("_n > 1").select("_short"), "repeated-hashes")
    return repeated, repeated.limit(FEW_REPEATED + 1).count()


def distinct_facts(facts: DataFrame) -> DataFrame:
    """One row per hash; which of several is kept is decided by the content of the row.

    Hashes that occur more than once are found first, in a pass that exchanges eight bytes a row. Only
    their rows are exchanged whole, so long as they are few; all others are the only ones of their hash.
    """
    order = [F.col(c) for c in facts.columns if c != "source_row_hash"]
    repeated, found = _repeated(facts)
    if not found:
        return facts
    if found > FEW_REPEATED:
        return keep_first(facts, ["source_row_hash"], order)
    marked, few = facts.withColumn("_short", F.xxhash64("source_row_hash")), F.broadcast(repeated)
    again = marked.join(few, "_short", "left_semi").select(facts.columns)
    return marked.join(few, "_short", "left_anti").select(facts.columns).unionByName(keep_first(again, ["source_row_hash"], order))


def lines_of_facts(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The accepted lines whose facts ``distinct_facts`` keeps. ``keys``: columns that identify a line.

    Lines that lose to another one of their hash are found once and left out by their keys, so the facts need
    not be written beside the lines, and readers compute only the columns that they use.
    """
    marks = [f"_key{n}" for n in range(len(keys))]
    typed = fact_transactions(lines, [F.col(key).alias(mark) for key, mark in zip(keys, marks, strict=True)])
    repeated, found = _repeated(typed)
    if not found:
        return lines
    if found <= FEW_REPEATED:
        typed = typed.join(F.broadcast(repeated), F.xxhash64("source_row_hash") == F.col("_short"), "left_semi")
    order = [F.col(c) for c in typed.columns if c != "source_row_hash"]
    rank = F.row_number().over(W.partitionBy("source_row_hash").orderBy(*order))
    later = stage(typed.withColumn("_rank", rank).where("_rank > 1").select(marks), "later-lines")
    same = [F.col(key).eqNullSafe(F.col(mark)) for key, mark in zip(keys, marks, strict=True)]
    return lines.join(later, same, "left_anti")


def cut_quantities(lines: DataFrame) -> DataFrame:
    """Number of accepted lines whose quantity has a fraction."""
    return lines.agg(F.count_if(F.col("quantity") != F.floor("quantity")).alias("cut_quantities"))


def daily_revenue(facts: DataFrame) -> DataFrame:
    """Rollup to day x product x country; sums and counts are partial before the shuffle."""
    sale, back = F.col("transaction_type") == SALE, F.col("transaction_type") == RETURN
    revenue, units = F.col("gross_revenue"), F.col("quantity").cast("bigint")

    def total(value: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    rolled = facts.groupBy(*DAILY_KEYS).agg(
        total(revenue, sale).cast("decimal(38,4)").alias("gross_sales"),
        total(revenue, back).cast("decimal(38,4)").alias("total_returns"),
        total(units, sale).alias("sale_quantity"),
        total(F.abs(units), back).alias("return_quantity"),
        F.count_if(sale).alias("sale_count"),
        F.count_if(back).alias("return_count"),
    )
    net = (F.col("gross_sales") - F.col("total_returns")).cast("decimal(38,4)")
    return rolled.select(*DAILY_KEYS, "gross_sales", "total_returns", net.alias("net_revenue"),
                         "sale_quantity", "return_quantity", "sale_count", "return_count")
