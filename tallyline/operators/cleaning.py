"""Cleaning and validation of unique lines.

Each rule is one step on the whole table. A line is never dropped here: the first rule that it
fails is written to ``reject_reason`` and the accepted and rejected sets are filters on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions.grouping import weighted_mode
from tallyline.functions.numbers import with_numbers
from tallyline.functions.text import product_code, with_blank_to_null
from tallyline.operators import dimensions, ingest, rejects
from tallyline.operators.categories import assign_category
from tallyline.schemas import (
    ANONYMOUS, BAD_DATE, BAD_PRICE, FACT_TRANSACTIONS, NO_CODE, NO_DESCRIPTION, NOT_NUMERIC, RETURN, SALE,
    TOO_LARGE, UNKNOWN_COUNTRY,
)
from tallyline.session import stage
from tallyline.sources.keywords import PIPELINE_KEYWORDS, KeywordMap

RAW_TEXTS = ["product_code", "description", "quantity", "unit_price", "customer_id"]


def coerce_numbers(lines: DataFrame) -> DataFrame:
    return with_numbers(lines, {"quantity": "quantity", "unit_price": "unit_price"})


def normalize_codes(lines: DataFrame) -> DataFrame:
    """``code_key`` is the stripped code (null if blank), ``product_code`` the normal form."""
    return with_blank_to_null(lines, {"code_key": "product_code"}).withColumn(
        "product_code", product_code(F.col("code_key"))
    )


def blank_descriptions(lines: DataFrame) -> DataFrame:
    """Strip descriptions and set blank ones to null, to be filled later."""
    return with_blank_to_null(lines, {"description": "description"})


def normalize_dates(lines: DataFrame) -> DataFrame:
    """``invoice_ts`` labelled UTC and its day ``date_id``; null where no layout parses."""
    return lines.withColumn("invoice_ts", dates.general_timestamp(F.col("invoice_date"))).withColumn(
        "date_id", F.to_date("invoice_ts")
    )


def normalize_customers(lines: DataFrame) -> DataFrame:
    """Blank -> ANONYMOUS, ``17850.0`` -> ``17850``, other texts stripped but unchanged."""
    text = with_blank_to_null(lines, {"customer_id": "customer_id"})
    whole = F.col("_customer_number").try_cast("bigint").cast("string")
    return with_numbers(text, {"_customer_number": "customer_id"}).withColumn(
        "customer_id", F.coalesce(whole, "customer_id", F.lit(ANONYMOUS))
    ).drop("_customer_number")


def tag_transaction_type(lines: DataFrame) -> DataFrame:
    return lines.withColumn(
        "transaction_type",
        F.when(F.col("quantity") > 0, SALE).when(F.col("quantity") <= 0, RETURN),
    )


def gross_revenue(lines: DataFrame) -> DataFrame:
    return lines.withColumn("gross_revenue", F.abs("quantity") * F.col("unit_price"))


def fill_country(lines: DataFrame) -> DataFrame:
    return lines.withColumn("country", F.coalesce("country", F.lit(UNKNOWN_COUNTRY)))


def reject_reason(lines: DataFrame) -> DataFrame:
    """First rule that fails, in the fixed order numbers, code, date, price, and what the facts can hold."""
    too_large = F.abs("quantity") >= 2.0 ** 63
    for name in ("unit_price", "gross_revenue"):
        kind = FACT_TRANSACTIONS[name].dataType
        too_large = too_large | (F.abs(name) >= 10.0 ** (kind.precision - kind.scale))
    bad_price = (F.col("transaction_type") == SALE) & (F.col("unit_price") <= 0)
    return lines.withColumn(
        "reject_reason",
        F.when(F.col("quantity").isNull() | F.col("unit_price").isNull(), NOT_NUMERIC)
        .when(F.col("code_key").isNull(), NO_CODE)
        .when(F.col("invoice_ts").isNull(), BAD_DATE)
        .when(bad_price, BAD_PRICE)
        .when(too_large, TOO_LARGE),
    )


def check_lines(unique: DataFrame) -> DataFrame:
    """All rules in order. Only narrow projections: no shuffle, whole-stage code generation.

    Raw texts are kept beside the cleaned ones, so the unique lines can be read back from the result.
    """
    return _rules(_with_raw_texts(unique))


def _with_raw_texts(lines: DataFrame) -> DataFrame:
    return lines.withColumns({f"{name}_raw": F.col(name) for name in RAW_TEXTS})


def _rules(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(coerce_numbers)
        .transform(normalize_codes)
        .transform(blank_descriptions)
        .transform(normalize_dates)
        .transform(normalize_customers)
        .transform(tag_transaction_type)
        .transform(gross_revenue)
        .transform(reject_reason)
        .withColumn("accepted", F.col("reject_reason").isNull())
    )


def staged_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The checked unique lines and the duplicates of combined lines, as partitions of one staged table.

    Both come from one exchange of the lines. Duplicates keep their raw texts only, so that no rule is
    computed on them.
    """
    raw = _with_raw_texts(ingest.marked_lines(lines))
    seen = raw.withColumns({name: F.when(~F.col("duplicate"), F.col(name)) for name in RAW_TEXTS})
    marked = stage(_rules(seen), "lines", ["duplicate", "accepted"])
    duplicates = raw_lines(marked.where("duplicate"), lines.columns)
    return marked.where("NOT duplicate").drop("duplicate"), ingest.with_duplicate_reason(duplicates)


def raw_lines(checked: DataFrame, columns: list[str]) -> DataFrame:
    """Lines as they came in."""
    return checked.select(*[
        F.col(f"{name}_raw").alias(name) if name in RAW_TEXTS else F.col(name) for name in columns
    ])


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("accepted").transform(fill_country)


def past_code_rule(checked: DataFrame) -> DataFrame:
    """Lines whose numbers and code are good: the set that description filling looks at."""
    reason = F.col("reject_reason")
    return checked.where(reason.isNull() | reason.isin(BAD_DATE, BAD_PRICE, TOO_LARGE))


def fill_names(checked: DataFrame) -> DataFrame:
    """Most frequent description per stripped code, in its original case."""
    named = past_code_rule(checked).where("description IS NOT NULL")
    return weighted_mode(named, ["code_key"], "description", F.lit(1), "fill_name")


def fill_description(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Fill missing descriptions from ``names`` and upper-case all of them."""
    filled = F.upper(F.coalesce("description", "fill_name", F.lit(NO_DESCRIPTION)))
    missing = F.col("description").isNull()
    # Only lines without a description are exchanged.
    named = lines.where(~missing).withColumn("description", F.upper("description"))
    found = lines.where(missing).join(names, "code_key", "left").withColumn("description", filled)
    return named.unionByName(found.select(named.columns))


def canonical_names(checked: DataFrame, names: DataFrame) -> DataFrame:
    """Most frequent filled description per normalised code over the accepted lines.

    Counts come first and descriptions are filled per (code, description), not per line, so a
    product that holds most of the lines is a handful of rows in the join.
    """
    counted = checked.where("accepted").groupBy("code_key", "product_code", "description").agg(
        F.count("*").alias("n")
    )
    filled = fill_description(counted, names)
    return weighted_mode(filled, ["product_code"], "description", F.col("n"), "canonical_name")


@dataclass
class Cleaned:
    """Outputs of one transformation run; each is a lazy frame over staged lines."""

    lines: DataFrame
    products: DataFrame
    customers: DataFrame
    rejected: DataFrame


def run_transformation(lines: DataFrame, keywords: KeywordMap = PIPELINE_KEYWORDS,
                       catalogue: DataFrame | None = None) -> Cleaned:
    """The whole chain from combined lines.

    The checked lines and the fill names are read several times: staged.
    """
    checked, duplicates = staged_lines(lines)
    names = stage(fill_names(checked), "fill-names")
    products = assign_category(canonical_names(checked, names), keywords, catalogue)
    return Cleaned(
        lines=accepted(checked),
        products=products,
        customers=dimensions.customers(accepted(checked)),
        rejected=rejects.rejected_rows(checked, names, duplicates),
    )
