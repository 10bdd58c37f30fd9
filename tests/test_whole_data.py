"""No line is lost on the way: values, dates, reruns, failed loads and staged tables."""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import session
from tallyline.__main__ import report
from tallyline.functions import dates
from tallyline.functions.grouping import subtract_copies
from tallyline.functions.numbers import percent
from tallyline.operators import upserts
from tallyline.operators.facts import daily_revenue
from tallyline.plans import business, metrics
from tallyline.plans.daily_run import Warehouse, run
from tallyline.sources.lines import read_source1
from tests.test_daily_run import SOURCE1, SOURCE2
from tests.test_loads import fact, facts_of, products_of

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


@pytest.fixture
def load(spark, tmp_path):
    def go(lines: str, run_id: str = "r1", **options):
        (tmp_path / "one.csv").write_text(HEADER + lines, encoding="latin-1")
        (tmp_path / "two.csv").write_text(SOURCE2.splitlines()[0] + "\n")
        counts = run(spark, str(tmp_path / "one.csv"), str(tmp_path / "two.csv"), str(tmp_path / "wh"), run_id, "2013-01-01", **options)
        return counts, Warehouse(spark, str(tmp_path / "wh"))

    return go


def test_large_values_and_late_years_are_loaded(load):
    counts, warehouse = load(
        "1,A,MUG,3000000000,1/5/2011 9:00,2,1,France\n2,A,MUG,2,1/5/2011 9:00,900000000,1,France\n"
        "3,A,MUG,1,6/7/2013 9:00,5,1,France\n4,A,MUG,1e30,1/5/2011 9:00,2,1,France\n5,A,MUG,1,1/5/2011 9:00,1e21,1,France\n")
    assert (counts.inserted, counts.rejected) == (3, 2)
    facts = {r.invoice_no: (r.quantity, r.unit_price, r.gross_revenue) for r in warehouse.facts().collect()}
    assert facts["1"] == (3_000_000_000, 2, 6_000_000_000) and facts["2"][1:] == (900_000_000, 1_800_000_000)
    log = {r.invoice_no: r.rejection_reason for r in warehouse.reject_log().collect()}
    assert log == {"4": "Valor fuera de rango", "5": "Valor fuera de rango"}
    months = business.monthly_net_sales(warehouse.daily())
    q2 = business.category_revenue(warehouse.daily(), warehouse.products())
    q5 = business.anonymous_vs_identified(warehouse.facts(), warehouse.customers())
    sums = [months.agg(F.sum("ventas_brutas")), q2.agg(F.sum("revenue_bruto_total")), q5.agg(F.sum("revenue_bruto"))]
    assert {df.first()[0] for df in sums} == {Decimal("7800000005.00")}
    assert warehouse.calendar().where("date_id = '2013-06-07'").count() == 1
    assert all(r.loaded_at is not None for r in warehouse.facts().collect())
    assert all(r.updated_at is not None for r in warehouse.daily().collect())
    assert all(r.rejected_at is not None for r in warehouse.reject_log().collect())


def test_totals_beyond_eighteen_digits(spark):
    facts = facts_of(spark, *[fact(n, revenue="20000000000000000", product=f"P{n}") for n in range(3)])
    daily, products = daily_revenue(facts), products_of(spark, "P0", "P1", "P2")
    assert business.category_revenue(daily, products).first().revenue_bruto_total == 60_000_000_000_000_000
    assert business.monthly_net_sales(daily).first().ventas_brutas == 60_000_000_000_000_000


def test_reports_hold_the_largest_lines_that_are_stored(load):
    largest = "1,A,MUG,1000000,1/5/2011 9:00,1e17,1,France\n2,B,MUG,-1000000,2/5/2011 9:00,1e17,,France\n"
    counts, warehouse = load(largest + "3,A,MUG,1,2/6/2010 9:00,0.0001,1,Spain\n4,B,MUG,1,2/6/2010 9:00,1e17,1,Spain\n")
    assert counts.inserted == 4
    for name in ("q1", "q2", "q3a", "q3b", "q4", "q5", "q6a", "q6b", "q6c", "q7", "alerts"):
        assert report(warehouse, name).collect() is not None
    months = {r.periodo: r.pct_devolucion for r in report(warehouse, "q1").collect()}
    assert months["2011-01"] == 0 and months["2011-02"] is None
    shares = [r.pct_del_total_revenue for r in report(warehouse, "q4").collect()]
    assert shares == [Decimal("100.00"), Decimal("0.00")]
    totals = business.monthly_totals(warehouse.daily())
    products = business.product_totals(warehouse.daily(), warehouse.products())
    for frame in (metrics.yoy_net_growth(totals), metrics.mom_net_change(totals), metrics.season_share(totals), metrics.return_rate_vs_average(totals),
                  metrics.anonymous_share(business.customer_type_totals(warehouse.facts(), warehouse.customers())),
                  metrics.ticket_vs_home(business.country_totals(warehouse.facts()), "France"), metrics.top_n_net_total(products)):
        assert frame.collect() is not None


def test_quotients_of_any_size(spark):
    cells = [("100000000000000000000000", "7"), ("1", "3"), ("1", "0"), ("9" * 32, "0.0001"), (None, "1"), ("200000000000000000000000", "400000000000000000000000")]
    frame = spark.createDataFrame(cells, "a string, b string").selectExpr("cast(a as decimal(38,4)) a", "cast(b as decimal(38,4)) b")
    found = [r[0] for r in frame.select(percent(F.col("a"), F.col("b"))).collect()]
    assert abs(float(found[0]) / (1e25 / 7) - 1) < 1e-12
    assert found[1:] == [Decimal("33.33"), None, None, None, Decimal("50.00")]


def test_rerun_without_rejects_empties_its_log(load):
    bad = "1,A,MUG,x,1/5/2011 9:00,2,1,France\n2,,MUG,1,1/5/2011 9:00,2,1,France\n"
    assert load(bad, "manual: 1/2")[0].rejected == 2
    counts, warehouse = load("3,A,MUG,1,1/5/2011 9:00,2,1,France\n", "manual: 1/2")
    assert counts.rejected == 0 and warehouse.reject_log().count() == 0
    assert load(bad, "other")[1].reject_log().select("run_id").distinct().collect() == [("other",)]


def test_run_after_a_broken_one(load, tmp_path):
    good = "1,A,MUG,1,1/5/2011 9:00,2,1,France\n"
    load(good)
    (tmp_path / "wh/dim_products/snapshot=2-broken").mkdir()
    (tmp_path / "wh/dim_products/snapshot=2-broken/part-0.parquet").write_bytes(b"half a file")
    for n in range(3):
        _, warehouse = load(good, f"r{n}")
    assert warehouse.products().count() == 1
    left = [p for p in os.listdir(tmp_path / "wh/dim_products") if p.startswith("snapshot=")]
    assert len(left) == 2 and not any("broken" in p for p in left)


def test_nothing_staged_is_left(spark, load):
    place = session.staging_root(spark)
    before = set(os.listdir(place)) if os.path.exists(place) else set()
    load("1,A,MUG,1,1/5/2011 9:00,2,1,France\n")
    assert set(os.listdir(place)) == before


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            applicationId, master = "app", "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        session.staging_root(Session)


def test_line_breaks_in_cells(load):
    counts, warehouse = load('1,A,"BLUE\nMUG",1,1/5/2011 9:00,2,1,France\n', multi_line=True)
    assert counts.inserted == 1 and warehouse.products().first().canonical_name == "BLUE\nMUG"


def test_another_column_order_fails(spark, tmp_path):
    head, *lines = SOURCE1.splitlines()
    names = head.split(",")
    (tmp_path / "x.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\n" + "\n".join(lines), encoding="latin-1")
    with pytest.raises(Exception, match="(?i)header"):
        read_source1(spark, str(tmp_path / "x.csv")).collect()


@pytest.mark.parametrize("text, day, time", [
    ("2010/12/01", "2010-12-01", "00:00:00"), ("2010-12-01 08:26:00.5", "2010-12-01", "08:26:00"), ("2010-12-01T08:26:00Z", "2010-12-01", "08:26:00"),
    ("2010-12-01T10:26:00+02:00", "2010-12-01", "08:26:00"), ("1-Dec-2010", "2010-12-01", "00:00:00"), ("Dec 1, 2010 8:26", "2010-12-01", "08:26:00"),
    ("1 December 2010", "2010-12-01", "00:00:00"), ("20101201", "2010-12-01", "00:00:00"), ("31-12-2010 8:26", "2010-12-31", "08:26:00"),
    ("12/1/2010 8:26 PM", "2010-12-01", "20:26:00"), ("12/1/2010 8:26", "2010-12-01", "08:26:00"), ("31/12/2010", "2010-12-31", "00:00:00"),
])
def test_date_layouts(spark, text, day, time):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(dates.iso_text(dates.general_timestamp(F.col("t")))).first()[0] == f"{day} {time}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_new_facts_exchange_the_input_once(spark):
    facts = facts_of(spark, fact(1), fact(2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(upserts.new_transactions(facts, facts.where("quantity > 0")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2  # one of the input, one of the stored hashes


def test_blank_names_count_before_the_join(spark):
    products = products_of(spark, "A").withColumn("canonical_name", F.lit(""))
    facts = facts_of(spark, fact(1, invoice="I1"), fact(2, invoice="I1"), fact(3, invoice="I2"))
    result = business.blank_names(products, facts)
    assert [tuple(r) for r in result.collect()] == [("A", "", "Cat", 2, 1)]
    text = plan(result)
    join = text.index("Join")
    assert "Aggregate" in text[join:]


def test_copies_are_restored_in_place(spark, monkeypatch):
    lines = spark.createDataFrame([("a",)] * 7 + [("b",)] * 2 + [("c",)], "x string")
    taken = spark.createDataFrame([("a",), ("c",)], "x string")
    for chunk in (100, 2):
        monkeypatch.setattr("tallyline.functions.grouping.COPIES_PER_CHUNK", chunk)
        rest = subtract_copies(lines, taken)
        assert sorted(r.x for r in rest.collect()) == ["a"] * 6 + ["b"] * 2


def test_rollup_keeps_update_times_of_untouched_rows(spark):
    old = datetime.datetime(2010, 1, 1)
    stored = daily_revenue(facts_of(spark, fact(1), fact(2, product="B"))).withColumn("updated_at", F.lit(old))
    merged = upserts.upsert_daily_revenue(stored, daily_revenue(facts_of(spark, fact(3))))
    assert {r.product_code: r.updated_at == old for r in merged.collect()} == {"A": False, "B": True}
