"""Reject log, counters and the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions.numbers import number_text
from tallyline.schemas import (
    ANONYMOUS, BAD_DATE, BAD_PRICE, CANONICAL_COLUMNS, NO_CODE, NO_DESCRIPTION, NO_REASON,
    NOT_NUMERIC, PIPELINE_RUNS, TOO_LARGE,
)


def rejected_lines(checked: DataFrame, names: DataFrame) -> DataFrame:
    """Rejected unique lines, every column as text, in the state in which the rule saw them.

    Numbers are already coerced; code and description are cleaned from the date rule on,
    customer, type and dates from the price rule on. ``names`` fills missing descriptions.
    """
    bad = checked.where("NOT accepted").join(names, "code_key", "left")
    reason = F.col("reject_reason")
    at_price = reason.isin(BAD_PRICE, TOO_LARGE)
    filled = F.upper(F.coalesce("description", "fill_name", F.lit(NO_DESCRIPTION)))

    def late(value: Column) -> Column:
        return F.when(at_price, value)

    columns = {
        "invoice_no": F.col("invoice_no"),
        "product_code": F.when(reason == NOT_NUMERIC, F.col("product_code_raw"))
        .when(reason == NO_CODE, F.col("code_key")).otherwise(F.col("product_code")),
        "description": F.when(reason.isin(BAD_DATE, BAD_PRICE, TOO_LARGE), filled).otherwise(F.col("description_raw")),
        "quantity": number_text(F.col("quantity")),
        "invoice_date": F.col("invoice_date"),
        "unit_price": number_text(F.col("unit_price")),
        "customer_id": F.when(at_price, F.col("customer_id")).otherwise(F.col("customer_id_raw")),
        "country": F.col("country"),
        "source": F.col("source"),
        "rejection_reason": reason,
        "transaction_type": late(F.col("transaction_type")),
        "invoice_date_utc": late(dates.iso_text_utc(F.col("invoice_ts"))),
        "date_id": late(F.col("date_id").cast("string")),
    }
    return bad.select(*[value.alias(name) for name, value in columns.items()])


def rejected_rows(checked: DataFrame, names: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Duplicates and rejected lines in one table; columns a set does not have are null."""
    rejected = rejected_lines(checked, names)
    if duplicates is None:
        return rejected
    known = duplicates.select(*CANONICAL_COLUMNS, "rejection_reason")
    return known.unionByName(rejected, allowMissingColumns=True)


def reject_log(rejected: DataFrame, default_source: str = "pipeline") -> DataFrame:
    """Log rows: the main columns, and all columns but the reason as one JSON object."""
    cells = [F.col(c).cast("string").alias(c) for c in rejected.columns if c != "rejection_reason"]
    return rejected.select(
        F.coalesce("source", F.lit(default_source)).alias("source"),
        "invoice_no",
        "product_code",
        F.coalesce("rejection_reason", F.lit(NO_REASON)).alias("rejection_reason"),
        F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).alias("raw_data"),
    )


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "rejection_reason"
    )


def pipeline_counts(checked: DataFrame, dedup_counts: DataFrame, products: DataFrame) -> DataFrame:
    """Valid lines, rejected lines (with duplicates) and products as one row."""
    lines = checked.agg(F.count_if("accepted").alias("valid"), F.count_if(~F.col("accepted")).alias("bad"))
    return lines.select(
        F.col("valid").alias("records_valid"),
        (F.col("bad") + dedup_counts.select("lines_removed").scalar()).alias("records_rejected"),
        products.agg(F.count("*").alias("n")).scalar().alias("products_count"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [table.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, table in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def past_date_rule(checked: DataFrame) -> DataFrame:
    """Lines that reach the customer and type rules: accepted, or rejected for their price or size."""
    reason = F.col("reject_reason")
    return checked.where(reason.isNull() | reason.isin(BAD_PRICE, TOO_LARGE))


def anonymous_impact(checked: DataFrame) -> DataFrame:
    return past_date_rule(checked).agg(
        F.count_if(F.col("customer_id") == ANONYMOUS).alias("anonymous_lines")
    )


def count_by_type(checked: DataFrame) -> DataFrame:
    return past_date_rule(checked).groupBy("transaction_type").agg(F.count("*").alias("n"))


def null_description_impact(past_code_rule: DataFrame) -> DataFrame:
    """Lines whose description had to be filled."""
    return past_code_rule.agg(F.count_if(F.col("description").isNull()).alias("repaired_descriptions"))


def run_log_row(spark: SparkSession, run_id: str, execution_date: str, extracted: Column, loaded: Column,
                rejected: Column, status: str = "SUCCESS", dag_run_id: str | None = None) -> DataFrame:
    """One row of the run log; the counters may be scalar subqueries."""
    now = F.current_timestamp()
    values = {
        "run_id": F.lit(run_id), "dag_run_id": F.lit(dag_run_id or run_id),
        "execution_date": F.lit(execution_date), "status": F.lit(status),
        "records_extracted": extracted, "records_loaded": loaded, "records_rejected": rejected,
        "started_at": now, "finished_at": now, "notes": F.lit(None),
    }
    return spark.range(1).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in PIPELINE_RUNS])
