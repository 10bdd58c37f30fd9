import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import quality
from tallyline.plans import business, daily_run
from tallyline.plans.daily_run import Warehouse, run
from tallyline.sources.lines import read_source1, read_source2

SOURCE1 = (
    "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    "1,85123A,WHITE HANGING HEART T-LIGHT HOLDER,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n"
    "2, 851 23a ,WHITE METAL LANTERN,3,1/5/2011 9:00,3.39,,España\n"
    "3,POST,POSTAGE,-1,1/6/2011 9:00,0,NA,France\n"
    "4,POST,POSTAGE,2,2/6/2011 9:00,18.00,12583,\n"
    '5,X1,"BAG, ""BIG""",abc,2/6/2011 9:00,1,12583,France\n'
    "6,,MISSING CODE,1,2/6/2011 9:00,1,12583,France\n"
    "7,X1,,1,31/12/2010 8:26,1,AB1,France\n"
    "8,X1,,1,someday,1,12583,France\n"
    "9,X1,n/a,1,2/6/2011 9:00,-2,12583,France\n"
    "10,X2,,4,2/6/2011 9:00,0.5,12583,France\n"
)
SOURCE2 = (
    "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    "1,85123A,CREAM HANGING HEART T-LIGHT HOLDER,6,2010-12-01 08:26:00,2.95,17850,United Kingdom\n"
    "1,85123A,CREAM HANGING HEART T-LIGHT HOLDER,6,2010-12-01 08:26:00,2.95,17850,United Kingdom\n"
    "11,X1,RED TOY,2,2009-12-01 07:45:00,1.25,13085.0,United Kingdom\n"
)


@pytest.fixture
def exports(tmp_path):
    (tmp_path / "data.csv").write_bytes(SOURCE1.encode("latin-1"))
    (tmp_path / "online.csv").write_bytes(SOURCE2.encode("utf-8"))
    return str(tmp_path / "data.csv"), str(tmp_path / "online.csv")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_reading(spark, exports):
    lines = {r.invoice_no: r for r in read_source1(spark, exports[0]).collect()}
    assert len(lines) == 10
    assert lines["1"].invoice_date == "2010-12-01 08:26:00"
    assert lines["7"].invoice_date == "2010-12-31 08:26:00"  # day first
    assert lines["8"].invoice_date is None
    assert lines["2"].country == "España" and lines["2"].product_code == " 851 23a "
    assert lines["3"].customer_id is None  # NA token
    assert lines["9"].description is None  # n/a token
    assert lines["5"].description == 'BAG, "BIG"'
    assert [r.source for r in read_source2(spark, exports[1]).collect()] == ["source2"] * 3


def test_byte_order_mark_and_folders(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for part, number in (("b.csv", 2), ("a.csv", 1)):
        (folder / part).write_bytes(b"\xef\xbb\xbf" + SOURCE2.replace("11,X1", f"{number},X1").encode("utf-8"))
    lines = read_source2(spark, str(folder))
    assert lines.count() == 6
    in_order = [r.invoice_no for r in lines.where("product_code = 'X1'").orderBy("line_order").collect()]
    assert in_order == ["1", "2"]  # by file name, not by the order of the splits


def test_run_and_rerun(spark, exports, tmp_path):
    root = str(tmp_path / "warehouse")
    counts = run(spark, *exports, root, "run-a", "2011-12-09")
    assert counts == daily_run.RunCounts(extracted=13, valid=7, inserted=7, skipped=0, rejected=6, products=4)
    warehouse = Warehouse(spark, root)
    tables = warehouse.tables()

    assert rows(tables["dim_products"], "product_code", "canonical_name", "category") == [
        # one line each of two names: the lower text wins
        ("85123A", "CREAM HANGING HEART T-LIGHT HOLDER", "Electrónica"),
        ("POST", "POSTAGE", "Papelería"),
        ("X1", "RED TOY", "Juguetes"),
        ("X2", "SIN DESCRIPCION", "Varios"),
    ]
    assert rows(tables["dim_customers"], "customer_id", "is_anonymous") == [
        ("12583", False), ("13085", False), ("17850", False), ("AB1", False), ("ANONYMOUS", True)]
    # the second export wins, with its price; the latest copy of a line is a duplicate
    first = tables["fact_transactions"].where("invoice_no = '1'").collect()
    assert [(r.source, str(r.unit_price), str(r.gross_revenue)) for r in first] == [("source2", "2.9500", "17.7000")]
    assert rows(tables["fact_transactions"].where("invoice_no = '4'"), "country") == [("Unknown",)]
    assert rows(tables["fact_transactions"].where("invoice_no = '3'"), "transaction_type", "quantity") == [("RETURN", -1)]
    assert rows(tables["log_rejected_records"].groupBy("rejection_reason").count(), "rejection_reason", "count") == [
        ("Duplicado", 2), ("Fecha invalida", 1), ("Precio Unitario <=0", 1), ("product_code nulo o vacio", 1),
        ("quantity o unit_price no es numerico", 1)]
    assert quality.fk_orphans(tables).agg(F.sum("orphan_rows")).first()[0] == 0
    assert quality.pk_violations(tables).agg(F.sum("repeated_keys")).first()[0] == 0
    assert quality.not_null_violations(tables).agg(F.sum("violations")).first()[0] == 0
    run_row = tables["log_pipeline_runs"].first()
    assert (run_row.run_id, run_row.status, run_row.records_extracted, run_row.records_loaded,
            run_row.records_rejected) == ("run-a", "SUCCESS", 13, 7, 6)

    facts_before = rows(tables["fact_transactions"], *tables["fact_transactions"].columns)
    daily_before = rows(tables["fact_daily_revenue"].drop("updated_at"), *schemas.FACT_DAILY_REVENUE.fieldNames())
    created = {r.product_code: r.created_at for r in tables["dim_products"].collect()}

    again = run(spark, *exports, root, "run-a", "2011-12-09")
    assert (again.inserted, again.skipped, again.rejected) == (0, 7, 6)
    tables = warehouse.tables()
    assert rows(tables["fact_transactions"], *tables["fact_transactions"].columns) == facts_before
    assert rows(tables["fact_daily_revenue"].drop("updated_at"), *schemas.FACT_DAILY_REVENUE.fieldNames()) == daily_before
    assert tables["log_rejected_records"].count() == 6
    assert tables["log_pipeline_runs"].select("records_loaded").collect() == [(7,)]  # kept from the first time
    products = {r.product_code: (r.created_at, r.updated_at) for r in tables["dim_products"].collect()}
    assert {k: v[0] for k, v in products.items()} == created
    assert all(updated > start for start, updated in products.values())


def test_later_run_adds_and_merges(spark, exports, tmp_path):
    root = str(tmp_path / "warehouse")
    run(spark, *exports, root, "run-a", "2011-12-09")
    more = tmp_path / "more.csv"
    more.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "12,POST,POSTAGE PAID,5,2/6/2011 9:00,18.00,12583,\n", encoding="latin-1")
    counts = run(spark, str(more), exports[1], root, "run-b", "2011-12-10")
    assert (counts.inserted, counts.skipped) == (1, 2)
    warehouse = Warehouse(spark, root)
    day = warehouse.daily().where("product_code = 'POST' AND date_id = '2011-02-06'").collect()
    assert [(r.sale_count, r.sale_quantity, str(r.gross_sales)) for r in day] == [(2, 7, "126.0000")]
    names = dict(rows(warehouse.products(), "product_code", "canonical_name"))
    assert names["POST"] == "POSTAGE PAID" and names["X2"] == "SIN DESCRIPCION"
    assert warehouse.runs().count() == 2 and warehouse.reject_log().count() == 7

    warehouse.register_views()
    total = spark.sql("SELECT sum(gross_sales) AS g FROM fact_daily_revenue").first().g
    q1 = business.monthly_net_sales(warehouse.daily())
    assert q1.agg(F.sum("ventas_brutas")).first()[0] == total
