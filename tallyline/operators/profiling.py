"""Profiling of the raw exports. Inputs are text lines: canonical names, values as in the file.

All reports group by ``source``, so both exports are profiled in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions.numbers import percent, rounded, with_numbers
from tallyline.schemas import CANONICAL_COLUMNS
from tallyline.session import stage

_DATA_COLUMNS = [c for c in CANONICAL_COLUMNS if c != "source"]


def file_order(lines: DataFrame) -> list[Column]:
    """Place in the file where it is known, else all columns."""
    if "line_order" in lines.columns:
        return [F.col("line_order")]
    return [F.col(c).asc_nulls_last() for c in _DATA_COLUMNS]


def shape(raw: dict[str, DataFrame]) -> DataFrame:
    """Row and column counts, names, types and names the other sources do not have."""
    rows = []
    for name, table in raw.items():
        fields = [f for f in table.schema.fields if f.name != "line_order"]
        others = {c for other, t in raw.items() if other != name for c in t.columns}
        rows.append(table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("source"), "n_rows",
            F.lit(len(fields)).cast("bigint").alias("n_columns"),
            F.lit(", ".join(f.name for f in fields)).alias("column_names"),
            F.lit(", ".join(f.dataType.simpleString() for f in fields)).alias("column_types"),
            F.lit(", ".join(f.name for f in fields if f.name not in others)).alias("only_here"),
        ))
    return reduce(DataFrame.unionByName, rows)


def sample(lines: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` lines."""
    return lines.orderBy(*file_order(lines)).limit(n).select(*CANONICAL_COLUMNS)


def zero_price_sample(lines: DataFrame, n: int = 5) -> DataFrame:
    zero = with_numbers(lines, {"p": "unit_price"}).where("p = 0").orderBy(*file_order(lines)).limit(n)
    return zero.select("invoice_no", "product_code", "description", "quantity", "unit_price")


def null_report(lines: DataFrame) -> DataFrame:
    """Columns with missing values: count and percent (rounded half to even)."""
    counted = lines.groupBy("source").agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in _DATA_COLUMNS]
    )
    long = counted.unpivot(["source", "n_rows"], _DATA_COLUMNS, "column_name", "nulls").where("nulls > 0")
    pct = F.bround(F.col("nulls").cast("decimal(20,0)") * 100 / F.col("n_rows").cast("decimal(20,0)"), 2)
    return long.select("source", "column_name", "nulls", pct.cast("decimal(18,2)").alias("pct"))


def quantity_profile(lines: DataFrame) -> DataFrame:
    counted = with_numbers(lines, {"q": "quantity"}).groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(F.col("q") > 0).alias("sales"),
        F.count_if(F.col("q") <= 0).alias("returns"), F.count_if(F.col("q").isNull()).alias("not_numeric"),
        F.min("q").alias("lo"), F.max("q").alias("hi"),
    )
    return counted.select(
        "source", "total", "sales", percent(F.col("sales"), F.col("total"), 1).alias("sales_pct"),
        "returns", percent(F.col("returns"), F.col("total"), 1).alias("returns_pct"), "not_numeric",
        rounded(F.col("lo"), 0).cast("bigint").alias("min_quantity"),
        rounded(F.col("hi"), 0).cast("bigint").alias("max_quantity"),
    )


def quantity_histogram(lines: DataFrame, low: int = -100, high: int = 200, sale_bins: int = 50,
                       return_bins: int = 20) -> DataFrame:
    """Clipped quantities in equal bins between the observed ends; the last bin is closed.

    Values are first counted per distinct clipped quantity and staged: the lines are read and
    parsed once, and the ends and the bins come from that small table.
    """
    clipped = F.when(F.col("q").isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.col("q"))))
    kind = F.when(F.col("q") > 0, "sale").otherwise("return")
    per_value = with_numbers(lines, {"q": "quantity"}).groupBy("source", clipped.alias("q")).agg(
        F.count("*").alias("n"))
    counted = stage(per_value, "quantities").where("q IS NOT NULL").withColumn("kind", kind)
    ends = counted.groupBy("source", "kind").agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        "source", "kind",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        F.when(F.col("kind") == "sale", sale_bins).otherwise(return_bins).alias("bins"),
    )
    number = F.least(
        F.floor((F.col("q") - F.col("lo")) * F.col("bins") / (F.col("hi") - F.col("lo"))),
        (F.col("bins") - 1).cast("bigint"),
    )
    # Two rows per source: small whatever the number of lines.
    filled = counted.join(F.broadcast(ends), ["source", "kind"]).withColumn("bin", number).groupBy(
        "source", "kind", "bin").agg(F.sum("n").alias("lines"))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("bins") - 1).cast("bigint"))))
    return every.join(filled, ["source", "kind", "bin"], "left").select(
        "source", "kind", "bin",
        rounded(F.col("lo") + F.col("bin") * width, 4).alias("bin_low"),
        rounded(F.col("lo") + (F.col("bin") + 1) * width, 4).alias("bin_high"),
        F.coalesce("lines", F.lit(0)).alias("n_lines"),
    )


def price_profile(lines: DataFrame) -> DataFrame:
    p = F.col("p")
    return with_numbers(lines, {"p": "unit_price"}).groupBy("source").agg(
        F.count_if(p == 0).alias("zero_prices"), F.count_if(p < 0).alias("negative_prices"),
        F.count_if(p.isNull()).alias("null_prices"),
        rounded(F.min(p), 4).alias("min_price"), rounded(F.max(p), 2).alias("max_price"),
        rounded(F.avg(p.cast("decimal(28,10)")), 2).alias("mean_price"),
    )


def date_profile(lines: DataFrame, sources: tuple[str, ...] | None = None) -> DataFrame:
    """Per source: text of the first line, first and last time, texts that do not parse.

    All sources of the lines unless some are named; there are as many as exports.
    """
    if sources is None:
        sources = tuple(r["source"] for r in lines.select("source").distinct().collect()) or ("",)
    stamped = lines.withColumn("ts", dates.general_timestamp(F.col("invoice_date")))
    ranges = stamped.groupBy("source").agg(
        dates.iso_text(F.min("ts")).alias("first_time"), dates.iso_text(F.max("ts")).alias("last_time"),
        F.count_if(F.col("ts").isNull()).alias("invalid_dates"),
    )
    firsts = [sample(lines.where(F.col("source") == source), 1) for source in sources]
    first = reduce(DataFrame.unionByName, firsts).select("source", F.col("invoice_date").alias("first_text"))
    return first.join(ranges, "source")


def source_overlap(lines: DataFrame) -> DataFrame:
    """End of source 1 and start of source 2."""
    stamped = lines.withColumn("ts", dates.general_timestamp(F.col("invoice_date")))
    return stamped.agg(
        F.to_date(F.max(F.when(F.col("source") == "source1", F.col("ts")))).alias("source1_ends"),
        F.to_date(F.min(F.when(F.col("source") == "source2", F.col("ts")))).alias("source2_starts"),
    )


def monthly_counts(lines: DataFrame) -> DataFrame:
    """Lines per month; lines without a date are left out after counting, so that the filter
    does not make Spark parse every date a second time."""
    month = dates.month_of(dates.general_timestamp(F.col("invoice_date")))
    return lines.withColumn("month", month).groupBy("source", "month").agg(
        F.count("month").alias("n_lines")).where("n_lines > 0")


def customer_profile(lines: DataFrame) -> DataFrame:
    """Missing and distinct customers; lines are counted per customer first."""
    per_customer = lines.groupBy("source", "customer_id").agg(F.count("*").alias("n"))
    counted = per_customer.groupBy("source").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("customer_id").alias("distinct_customers"),
    )
    return counted.select("source", F.col("missing").alias("missing_customers"),
                          percent(F.col("missing"), F.col("total"), 1).alias("missing_pct"),
                          "distinct_customers")


def description_variants(lines: DataFrame) -> DataFrame:
    """Distinct descriptions per product code."""
    return lines.where("product_code IS NOT NULL").groupBy("product_code").agg(
        F.count_distinct("description").alias("variants"))


def most_varied_codes(lines: DataFrame, n: int = 5) -> DataFrame:
    return description_variants(lines).orderBy(F.desc("variants"), "product_code").limit(n)


def variant_summary(lines: DataFrame) -> DataFrame:
    return description_variants(lines).agg(
        F.count("*").alias("product_codes"), F.count_if(F.col("variants") > 1).alias("codes_with_variants"))


def variants_of_top_code(lines: DataFrame, n: int = 8) -> DataFrame:
    """Frequency of each description of the most varied code; the first one is its name."""
    top = most_varied_codes(lines, 1).select("product_code").scalar()
    counted = lines.where(F.col("product_code") == top).where("description IS NOT NULL").groupBy(
        "product_code", "description").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "description").limit(n)


def nonnumeric_codes(lines: DataFrame, examples: int = 10) -> DataFrame:
    """Lines whose code does not start with a digit (a missing code counts), with examples."""
    digit_first = F.coalesce(F.col("product_code").rlike(r"(?U)^\d"), F.lit(False))
    per_code = stage(
        lines.where(~digit_first).groupBy("product_code").agg(F.count("*").alias("n")), "nonnumeric-codes")
    total = per_code.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).scalar()
    return per_code.orderBy(F.col("product_code").asc_nulls_first()).limit(examples).select(
        F.col("product_code").alias("example"), "n", total.alias("nonnumeric_lines"))


def duplicate_profile(lines: DataFrame) -> DataFrame:
    """Repeated lines inside each source; the date text is part of the key here."""
    keys = ["source", "invoice_no", "product_code", "quantity", "invoice_date"]
    return lines.groupBy(*keys).agg(F.count("*").alias("n")).groupBy("source").agg(
        F.sum(F.col("n") - 1).alias("duplicates"))


def overlapping_invoices(lines: DataFrame) -> DataFrame:
    """Invoices that occur in both sources; one partial aggregation, no join."""
    per_invoice = lines.where("invoice_no IS NOT NULL").groupBy("invoice_no").agg(
        F.bool_or(F.col("source") == "source1").alias("in1"),
        F.bool_or(F.col("source") == "source2").alias("in2"))
    return per_invoice.agg(F.count_if(F.col("in1") & F.col("in2")).alias("overlapping_invoices"))


def country_profile(lines: DataFrame, n: int = 10) -> DataFrame:
    """Top countries by lines, with the number of distinct countries."""
    per_country = stage(
        lines.where("country IS NOT NULL").groupBy("country").agg(F.count("*").alias("n_lines")), "countries")
    distinct = per_country.agg(F.count("*").alias("d")).scalar()
    return per_country.orderBy(F.desc("n_lines"), "country").limit(n).select(
        "country", "n_lines", distinct.alias("distinct_countries"))
