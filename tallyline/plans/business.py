"""Business questions over the rollup, the facts and the dimensions.

Joins with a dimension happen after an aggregation to its key: the join then has one row per key
on each side, so no key can be hot in it. Grouped results that are used for the rows and for a
total of all rows are staged, so the facts are read once and the total needs no global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import hundredfold, percent, ratio, rounded
from tallyline.functions.ranking import top_fraction_cut
from tallyline.operators.monthly import totals
from tallyline.schemas import ALERT_TEXT, DAILY_MEASURES, NO_DESCRIPTION, SALE
from tallyline.session import stage


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names or DAILY_MEASURES]


def monthly_totals(daily: DataFrame) -> DataFrame:
    """Unrounded measures per month. The month is taken from the date, so no day is lost that a
    calendar table does not hold."""
    day = F.col("date_id")
    return daily.groupBy(
        F.year(day).cast("smallint").alias("year"), F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.date_format(day, "yyyy-MM").alias("periodo"),
    ).agg(*_sums())


def monthly_net_sales(daily: DataFrame) -> DataFrame:
    totals = monthly_totals(daily)
    return totals.select(
        "year", "month", "month_name", "periodo",
        rounded(F.col("gross_sales")).alias("ventas_brutas"),
        rounded(F.col("total_returns")).alias("devoluciones"),
        rounded(F.col("net_revenue")).alias("ventas_netas"),
        F.col("sale_count").alias("num_transacciones_venta"),
        F.col("return_count").alias("num_devoluciones"),
        percent(F.col("total_returns"), F.col("gross_sales")).alias("pct_devolucion"),
    ).orderBy("year", "month")


def product_totals(daily: DataFrame, products: DataFrame) -> DataFrame:
    """Unrounded measures per product, with its name and category."""
    per_product = daily.groupBy("product_code").agg(*_sums())
    return per_product.join(products.select("product_code", "canonical_name", "category"), "product_code")


def category_totals(daily: DataFrame, products: DataFrame) -> DataFrame:
    return product_totals(daily, products).groupBy("category").agg(*_sums())


def category_revenue(daily: DataFrame, products: DataFrame) -> DataFrame:
    totals = stage(category_totals(daily, products), "category-totals")
    everything = totals.agg(F.sum("gross_sales").alias("t")).scalar()
    return totals.select(
        "category",
        rounded(F.col("gross_sales")).alias("revenue_bruto_total"),
        rounded(F.col("total_returns")).alias("total_devoluciones"),
        rounded(F.col("net_revenue")).alias("revenue_neto_total"),
        F.col("sale_count").alias("num_ventas"),
        F.col("return_count").alias("num_devoluciones"),
        percent(F.col("total_returns"), F.col("gross_sales")).alias("pct_devolucion"),
        percent(F.col("gross_sales"), everything).alias("pct_del_total_revenue"),
    ).orderBy(F.desc("revenue_bruto_total"), "category")


def top_net_revenue(daily: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    return product_totals(daily, products).select(
        "product_code", "canonical_name", "category",
        rounded(F.col("gross_sales")).alias("revenue_bruto"),
        rounded(F.col("total_returns")).alias("devoluciones"),
        rounded(F.col("net_revenue")).alias("revenue_neto"),
        F.col("sale_quantity").alias("unidades_vendidas"),
    ).orderBy(F.desc("revenue_neto"), "product_code").limit(n)


def top_return_rate(daily: DataFrame, products: DataFrame, n: int = 10, min_sales: int = 10) -> DataFrame:
    return product_totals(daily, products).where(F.col("sale_count") >= min_sales).select(
        "product_code", "canonical_name", "category",
        F.col("sale_count").alias("num_ventas"),
        F.col("return_count").alias("num_devoluciones"),
        rounded(F.col("gross_sales")).alias("revenue_bruto"),
        rounded(F.col("total_returns")).alias("monto_devuelto"),
        percent(F.col("total_returns"), F.col("gross_sales")).alias("tasa_devolucion_pct"),
    ).orderBy(F.desc_nulls_first("tasa_devolucion_pct"), "product_code").limit(n)


def country_totals(facts: DataFrame) -> DataFrame:
    """Unrounded sales per country. The distinct count is spread over (country, invoice) first."""
    return facts.where(F.col("transaction_type") == SALE).groupBy("country").agg(
        F.count_distinct("invoice_no").alias("num_facturas"),
        F.count("*").alias("num_lineas_venta"),
        F.sum("gross_revenue").alias("revenue"),
    )


def country_totals_of_months(monthly: DataFrame) -> DataFrame:
    """The same from monthly sales: no fact is read."""
    return totals(monthly, "country").select(
        "country", F.col("invoices").alias("num_facturas"), F.col("lines").alias("num_lineas_venta"), "revenue")


def countries(facts: DataFrame, n: int = 15) -> DataFrame:
    return country_report(country_totals(facts), n)


def country_report(country_totals: DataFrame, n: int = 15) -> DataFrame:
    per_country = stage(country_totals, "country-totals")
    everything = per_country.agg(F.sum("revenue").alias("t")).scalar()
    return per_country.select(
        "country", "num_facturas", "num_lineas_venta",
        rounded(F.col("revenue")).alias("revenue_bruto_total"),
        ratio(F.col("revenue"), F.col("num_facturas")).alias("ticket_promedio_por_factura"),
        percent(F.col("revenue"), everything).alias("pct_del_total_revenue"),
    ).orderBy(F.desc("revenue_bruto_total"), "country").limit(n)


def customer_type_totals(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Unrounded sales by identified / anonymous.

    Lines are added up per (customer, invoice) before the join with the customers, and the two
    distinct counts expand only those sums.
    """
    invoices = facts.where(F.col("transaction_type") == SALE).groupBy("customer_id", "invoice_no").agg(
        F.count("*").alias("lines"), F.sum("gross_revenue").alias("revenue"))
    flagged = invoices.join(customers.select("customer_id", "is_anonymous"), "customer_id")
    return flagged.groupBy("is_anonymous").agg(
        F.count_distinct("customer_id").alias("num_clientes"),
        F.count_distinct("invoice_no").alias("num_facturas"),
        F.sum("lines").alias("num_lineas"),
        F.sum("revenue").alias("revenue"),
    )


def customer_type_totals_of_months(monthly: DataFrame) -> DataFrame:
    """The same from monthly sales: no fact is read."""
    return totals(monthly, "is_anonymous").select(
        "is_anonymous", F.col("customers").alias("num_clientes"), F.col("invoices").alias("num_facturas"),
        F.col("lines").alias("num_lineas"), "revenue")


def anonymous_vs_identified(facts: DataFrame, customers: DataFrame, with_flag: bool = False) -> DataFrame:
    return customer_type_report(customer_type_totals(facts, customers), with_flag)


def customer_type_report(customer_type_totals: DataFrame, with_flag: bool = False) -> DataFrame:
    label = F.when(F.col("is_anonymous"), "Sin cliente").otherwise("Identificado")
    flag = ["is_anonymous"] if with_flag else []
    return customer_type_totals.orderBy("is_anonymous").select(
        *flag, label.alias("tipo_cliente"), "num_clientes", "num_facturas", "num_lineas",
        rounded(F.col("revenue")).alias("revenue_bruto"),
        ratio(F.col("revenue"), F.col("num_facturas")).alias("ticket_promedio"),
        ratio(F.col("num_facturas"), F.col("num_clientes")).alias("facturas_por_cliente"),
    )


def unique_codes(products: DataFrame) -> DataFrame:
    return products.agg(F.count_distinct("product_code").alias("total_codigos_unicos"))


def undescribed_products(products: DataFrame, facts: DataFrame) -> DataFrame:
    """Products without a usable name and their lines; products without lines count 0."""
    name = F.col("canonical_name")
    wanted = products.where((name == NO_DESCRIPTION) | name.isNull())
    per_product = facts.groupBy("product_code").agg(F.count("*").alias("n"))
    return wanted.join(per_product, "product_code", "left").select(
        "product_code", "canonical_name", "category",
        F.coalesce("n", F.lit(0)).alias("num_transacciones"),
    ).orderBy(F.desc("num_transacciones"), "product_code")


def blank_names(products: DataFrame, facts: DataFrame) -> DataFrame:
    """Products with an empty name. ``variaciones_codigo`` counts spellings of the code itself."""
    name = F.col("canonical_name")
    wanted = products.where(name.isNull() | (name == "")).select("product_code", "canonical_name", "category")
    # Only lines of these products are counted, and before the join, so that a product is one row in it.
    lines = facts.select("product_code", "invoice_no").join(wanted.select("product_code"), "product_code", "left_semi")
    invoices = lines.distinct().groupBy("product_code").agg(F.count("invoice_no").alias("num_transacciones"))
    # Products are unique by code: the spellings of one code are one.
    return wanted.join(invoices, "product_code").select(
        "product_code", F.col("canonical_name").alias("nombre_canonico"), "category", "num_transacciones",
        F.lit(1).cast("bigint").alias("variaciones_codigo"),
    ).orderBy(F.desc("num_transacciones"), "product_code")


def _critical_products(daily: DataFrame, products: DataFrame, min_sales: int, top_revenue: float,
                       top_rate: float) -> DataFrame:
    """Products in the top shares of both revenue and return rate.

    A descending percent rank within a fraction is the same as a value at or above a cut, so
    only the two cuts are needed and not a rank for each row. The per-product summary feeds both
    cuts and the result: staged.
    """
    rate = F.coalesce(
        F.when(F.col("gross_sales") > 0, hundredfold(F.col("total_returns"), F.col("gross_sales"))),
        F.lit(0),
    )
    relevant = product_totals(daily, products).where(F.col("sale_count") >= min_sales)
    summary = stage(relevant.withColumn("rate", rate), "product-summary")
    revenue_cut = top_fraction_cut(summary, "gross_sales", top_revenue).scalar()
    rate_cut = top_fraction_cut(summary, "rate", top_rate).scalar()
    return summary.where((F.col("gross_sales") >= revenue_cut) & (F.col("rate") >= rate_cut)).orderBy(
        F.desc(rounded(F.col("gross_sales"))), "product_code")


def _critical_columns() -> list[Column | str]:
    return [
        "product_code", "canonical_name", "category",
        rounded(F.col("gross_sales")).alias("revenue_bruto"),
        rounded(F.col("total_returns")).alias("monto_devuelto"),
        rounded(F.col("net_revenue")).alias("revenue_neto"),
        F.col("sale_count").alias("num_ventas"),
        F.col("return_count").alias("num_devoluciones"),
        rounded(F.col("rate")).alias("tasa_devolucion_pct"),
    ]


def recommendation(daily: DataFrame, products: DataFrame, n: int = 10, min_sales: int = 20,
                   top_revenue: float = 0.30, top_rate: float = 0.20) -> DataFrame:
    return _critical_products(daily, products, min_sales, top_revenue, top_rate).limit(n).select(
        *_critical_columns())


def alerts(daily: DataFrame, products: DataFrame, min_sales: int = 20, top_revenue: float = 0.30,
           top_rate: float = 0.20) -> DataFrame:
    return _critical_products(daily, products, min_sales, top_revenue, top_rate).select(
        *_critical_columns(), F.lit(ALERT_TEXT).alias("alerta"))
