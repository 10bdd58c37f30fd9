"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.schemas import ANONYMOUS


def is_anonymous() -> Column:
    return F.col("customer_id") == ANONYMOUS


def customers(lines: DataFrame) -> DataFrame:
    return lines.select("customer_id").distinct().withColumn("is_anonymous", is_anonymous())


def products(named: DataFrame) -> DataFrame:
    """Code, name and category; name and category depend on the code alone."""
    return named.select("product_code", "canonical_name", "category").dropDuplicates(["product_code"])


def calendar(spark: SparkSession, first: str = "2009-01-01", last: str = "2012-12-31") -> DataFrame:
    """One row per day. Weeks are ISO weeks, day 0 is Monday."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_id")
    )
    day = F.col("date_id")
    return days.select(
        "date_id",
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.weekday(day).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def calendar_around(spark: SparkSession, days: tuple[str, str] | None, first: str, last: str) -> DataFrame:
    """The calendar from ``first`` to ``last``, widened to whole years around the given days."""
    if days:
        first, last = min(first, f"{days[0][:4]}-01-01"), max(last, f"{days[1][:4]}-12-31")
    return calendar(spark, first, last)


def anonymous_customer(spark: SparkSession, first: str = "2009-01-01",
                       last: str = "2012-12-31") -> DataFrame:
    """Seed row for lines without a customer."""
    return spark.range(1).select(
        F.lit(ANONYMOUS).alias("customer_id"), F.lit(True).alias("is_anonymous"),
        F.lit(first).cast("date").alias("first_seen_at"), F.lit(last).cast("date").alias("last_seen_at"),
    )


def seen_range(customers: DataFrame, facts: DataFrame) -> DataFrame:
    """First and last day of each customer, from partial aggregates over the facts."""
    seen = facts.groupBy("customer_id").agg(
        F.min("date_id").alias("first_seen_at"), F.max("date_id").alias("last_seen_at")
    )
    return customers.drop("first_seen_at", "last_seen_at").join(seen, "customer_id", "left")
