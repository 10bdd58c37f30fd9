import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import dimensions, quality, rejects, upserts
from tallyline.plans import business, metrics

OLD, NOW = datetime.datetime(2010, 1, 1), datetime.datetime(2011, 1, 1)


def test_upsert_products(spark):
    stored = spark.createDataFrame([("A", "OLD A", "X", False, OLD, OLD), ("B", "OLD B", "X", True, OLD, OLD)], schemas.DIM_PRODUCTS)
    incoming = spark.createDataFrame([("A", None, "Y"), ("C", "NEW C", "Y")], "product_code string, canonical_name string, category string")
    got = {r.product_code: tuple(r)[1:] for r in upserts.upsert_products(stored, incoming, F.lit(NOW)).collect()}
    assert got == {"A": (None, "Y", False, OLD, NOW), "B": ("OLD B", "X", True, OLD, OLD), "C": ("NEW C", "Y", True, NOW, NOW)}


def test_insert_customers_keeps_known_ones(spark):
    seed = dimensions.anonymous_customer(spark)
    incoming = spark.createDataFrame([("ANONYMOUS", False), ("1", False), ("1", False)], "customer_id string, is_anonymous boolean")
    got = sorted((r.customer_id, r.is_anonymous, str(r.first_seen_at)) for r in upserts.insert_customers(seed, incoming).collect())
    assert got == [("1", False, "None"), ("ANONYMOUS", True, "2009-01-01")]


def fact(number, date="2011-01-05", kind="SALE", revenue="10", product="A", customer="1", country="France", invoice=None):
    return (invoice or f"I{number}", product, customer, datetime.datetime(2011, 1, 5), datetime.date.fromisoformat(date),
            2, Decimal("5"), Decimal(revenue), country, kind, "source2", f"h{number}")


def facts_of(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.FACT_TRANSACTIONS)


def test_insert_transactions_counts(spark):
    stored, incoming = facts_of(spark, fact(1)), facts_of(spark, fact(1), fact(2), fact(2), fact(3))
    new = upserts.new_transactions(stored, incoming)
    assert sorted(r.source_row_hash for r in new.collect()) == ["h2", "h3"]


def test_upsert_run_changes_status_and_finish_only(spark):
    first = (rejects.run_log_row(spark, "r", "2011-01-01", F.lit(5), F.lit(4), F.lit(1), status="RUNNING")
             .withColumn("started_at", F.lit(OLD)).withColumn("finished_at", F.lit(OLD)))
    second = rejects.run_log_row(spark, "r", "2012-01-01", F.lit(9), F.lit(9), F.lit(9))
    merged = upserts.upsert_run(first, second.withColumn("finished_at", F.lit(NOW))).collect()
    assert len(merged) == 1
    row = merged[0]
    assert (row.status, row.finished_at, row.started_at, row.records_extracted, row.execution_date) == (
        "SUCCESS", NOW, OLD, 5, datetime.date(2011, 1, 1))


def test_calendar(spark):
    days = {str(r.date_id): r for r in dimensions.calendar(spark).collect()}
    assert len(days) == 1461
    first = days["2011-01-01"]
    assert (first.week_of_year, first.day_of_week, first.day_name, first.month_name, first.is_weekend, first.quarter) == (
        52, 5, "Saturday", "January", True, 1)
    assert days["2011-01-03"].day_of_week == 0 and not days["2011-01-03"].is_weekend


def test_constraint_reports_find_violations(spark):
    facts = facts_of(spark, fact(1), fact(1), fact(2, product="Z" * 31, kind="OTHER"), fact(3, date="1999-01-01", customer="ghost"))
    tables = {"fact_transactions": facts.withColumn("country", F.lit(None).cast("string")),
              "dim_products": spark.createDataFrame([("A",)], "product_code string"),
              "dim_customers": spark.createDataFrame([("1",)], "customer_id string"), "dim_date": dimensions.calendar(spark)}
    orphans = {(r.table_name, r.key_name): r.orphan_rows for r in quality.fk_orphans(tables).collect()}
    assert orphans == {("fact_transactions", "product_code"): 1, ("fact_transactions", "customer_id"): 1, ("fact_transactions", "date_id"): 1}
    repeated = {r.table_name: r.repeated_keys for r in quality.pk_violations({"fact_transactions": facts}).collect()}
    assert repeated == {"fact_transactions": 1}
    assert quality.domain_violations(facts).first()[0] == 1
    long = {r.column_name: r.violations for r in quality.length_violations({"fact_transactions": facts}).collect()}
    assert long["product_code"] == 1 and long["invoice_no"] == 0
    nulls = quality.not_null_violations({"fact_transactions": facts.withColumn("source", F.lit(None).cast("string"))}).where("violations > 0")
    assert [(r.column_name, r.violations) for r in nulls.collect()] == [("source", 4)]


def daily_of(spark, *rows):
    """(product, gross, returns, sales) per row, all on one day."""
    full = [(datetime.date(2011, 1, 5), p, "France", Decimal(g), Decimal(r), Decimal(g) - Decimal(r), n, 1, n, 1) for p, g, r, n in rows]
    return spark.createDataFrame(full, schemas.FACT_DAILY_REVENUE)


def products_of(spark, *codes):
    return spark.createDataFrame([(c, f"N {c}", "Cat") for c in codes], "product_code string, canonical_name string, category string")


def test_rates_without_sales(spark):
    daily, products = daily_of(spark, ("A", "0", "5", 30), ("B", "100", "10", 30)), products_of(spark, "A", "B")
    rates = {r.product_code: r.tasa_devolucion_pct for r in business.top_return_rate(daily, products).collect()}
    assert rates == {"A": None, "B": Decimal("10.00")}
    assert business.top_return_rate(daily, products, n=1).first().product_code == "A"  # no rate sorts first
    only = business.alerts(daily_of(spark, ("A", "0", "5", 30)), products).collect()
    assert [(r.product_code, r.tasa_devolucion_pct) for r in only] == [("A", Decimal("0.00"))]  # one product: both ranks 0
    assert business.monthly_net_sales(daily_of(spark, ("A", "0", "5", 1))).first().pct_devolucion is None


def test_totals_agree_across_groupings(spark):
    rows = [fact(n, kind="RETURN" if n % 7 == 0 else "SALE", revenue=f"{n}.37", product=f"P{n % 5}", customer="ANONYMOUS" if n % 3 else f"{n}",
                 country=f"C{n % 4}") for n in range(1, 80)]
    facts = facts_of(spark, *rows)
    from tallyline.operators.facts import daily_revenue

    daily, products = daily_revenue(facts), products_of(spark, *[f"P{n}" for n in range(5)])
    customers = facts.select("customer_id").distinct().withColumn("is_anonymous", F.col("customer_id") == "ANONYMOUS")
    expected = sum(r[7] for r in rows if r[9] == "SALE")
    assert business.monthly_totals(daily).agg(F.sum("gross_sales")).first()[0] == expected
    assert business.category_totals(daily, products).agg(F.sum("gross_sales")).first()[0] == expected
    assert business.customer_type_totals(facts, customers).agg(F.sum("revenue")).first()[0] == expected
    assert business.country_totals(facts).agg(F.sum("revenue")).first()[0] == expected


def test_published_metrics(spark):
    months = [(2010, 11, 1416608.67), (2011, 11, 1455342.22), (2010, 10, 1081021.99), (2010, 12, 746360.25)]
    frame = spark.createDataFrame([(y, m, Decimal(str(n))) for y, m, n in months], "year int, month int, net_revenue decimal(24,4)")
    assert [str(r.crecimiento_pct) for r in metrics.yoy_net_growth(frame).collect()] == ["2.73"]
    assert {(r.year, r.month): str(r.variacion_pct) for r in metrics.mom_net_change(frame).collect()} == {(2010, 11): "31.04", (2010, 12): "-47.31"}
    types = spark.createDataFrame([(False, Decimal("17366007.00"), 36968), (True, Decimal("3099566.69"), 3109)],
                                  "is_anonymous boolean, revenue decimal(24,4), num_facturas long")
    assert tuple(map(str, metrics.anonymous_share(types).first())) == ("15.15", "2.12")
    countries = spark.createDataFrame([("United Kingdom", Decimal("17408156.59"), 36535), ("Netherlands", Decimal("554038.09"), 228)],
                                      "country string, revenue decimal(24,4), num_facturas long")
    ticket = {r.country: str(r.veces_local) for r in metrics.ticket_vs_home(countries, "United Kingdom").collect()}
    assert ticket == {"United Kingdom": "1.00", "Netherlands": "5.10"}
