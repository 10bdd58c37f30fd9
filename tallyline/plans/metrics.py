"""Figures derived from the business results.

Inputs are grouped already: months, categories, countries, products or customer types, never
lines. Where a function reads its input twice it stages it, so the grouping runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import percent, quotient, ratio, rounded
from tallyline.schemas import NO_DESCRIPTION
from tallyline.session import stage

_MONTH_NUMBER = "year * 12 + month"


def _change(months: DataFrame, distance: int, name: str) -> DataFrame:
    """Net sales against the month ``distance`` months earlier; months may be missing."""
    months = stage(months, "months")
    now = months.select("year", "month", F.expr(_MONTH_NUMBER).alias("at"), F.col("net_revenue").alias("net"))
    before = months.select((F.expr(_MONTH_NUMBER) + distance).alias("at"), F.col("net_revenue").alias("earlier"))
    return now.join(before, "at").select(
        "year", "month", rounded(F.col("net")).alias("ventas_netas"),
        rounded(F.col("earlier")).alias("ventas_anteriores"),
        percent(F.col("net") - F.col("earlier"), F.col("earlier")).alias(name),
    )


def yoy_net_growth(months: DataFrame) -> DataFrame:
    return _change(months, 12, "crecimiento_pct")


def mom_net_change(months: DataFrame) -> DataFrame:
    return _change(months, 1, "variacion_pct")


def season_share(months: DataFrame, season: tuple[int, ...] = (10, 11, 12)) -> DataFrame:
    """Share of the season's months in the net sales of each year."""
    inside = F.sum(F.when(F.col("month").isin(*season), F.col("net_revenue")).otherwise(0))
    return months.groupBy("year").agg(
        rounded(inside).alias("temporada"), rounded(F.sum("net_revenue")).alias("anual"),
        percent(inside, F.sum("net_revenue")).alias("temporada_pct"),
    )


def return_rate_vs_average(months: DataFrame) -> DataFrame:
    """Return rate of each month over the rate of all months."""
    months = stage(months, "months")
    overall = months.agg(quotient(F.sum("total_returns"), F.sum("gross_sales")).alias("r")).scalar()
    rate = quotient(F.col("total_returns"), F.col("gross_sales"))
    return months.select("year", "month", rounded(rate * 100).alias("pct_devolucion"),
                         rounded(overall * 100).alias("pct_global"),
                         rounded(F.try_divide(rate.cast("double"), overall.cast("double"))).alias("veces"))


def anonymous_share(types: DataFrame) -> DataFrame:
    """Share of anonymous sales and their ticket over the ticket of identified customers."""
    def of(value: Column, anonymous: bool) -> Column:
        return F.max(F.when(F.col("is_anonymous") == anonymous, value))

    ticket = quotient(F.col("revenue"), F.col("num_facturas")).cast("double")
    return types.agg(
        percent(of(F.col("revenue"), True), F.sum("revenue")).alias("anonimo_pct"),
        rounded(F.try_divide(of(ticket, True), of(ticket, False))).alias("ticket_veces"),
    )


def ticket_vs_home(by_country: DataFrame, home: str) -> DataFrame:
    """Ticket of each country over the ticket of the home country."""
    by_country = stage(by_country, "countries")
    ticket = quotient(F.col("revenue"), F.col("num_facturas")).cast("double")
    at_home = by_country.where(F.col("country") == home).select(ticket.alias("t")).scalar()
    return by_country.select(
        "country", ratio(F.col("revenue"), F.col("num_facturas")).alias("ticket_promedio"),
        rounded(F.try_divide(ticket, at_home)).alias("veces_local"),
    )


def top_n_net_total(products: DataFrame, n: int = 3) -> DataFrame:
    """Net revenue of the ``n`` best sellers together."""
    best = products.orderBy(F.desc("net_revenue"), "product_code").limit(n)
    return best.agg(F.count("*").alias("productos"), rounded(F.sum("net_revenue")).alias("revenue_neto"))


def described_share(products: DataFrame) -> DataFrame:
    described = F.count_if(F.coalesce(F.col("canonical_name") != NO_DESCRIPTION, F.lit(False)))
    return products.agg(F.count("*").alias("productos"), described.alias("con_descripcion"),
                        percent(described, F.count("*")).alias("con_descripcion_pct"))


def category_rate_ratio(categories: DataFrame, base: str) -> DataFrame:
    """Return rate of each category over the rate of the base category."""
    categories = stage(categories, "categories")
    rate = quotient(F.col("total_returns"), F.col("gross_sales")).cast("double")
    base_rate = categories.where(F.col("category") == base).select(rate.alias("r")).scalar()
    return categories.select("category", rounded(rate * 100).alias("pct_devolucion"),
                             rounded(F.try_divide(rate, base_rate)).alias("veces_base"))
