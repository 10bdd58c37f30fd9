import pytest

from tallyline.operators import catalogue
from tallyline.sources.lines import source2_lines


def records(df):
    return {r.code: (r.name, r.category, r.is_active) for r in df.collect()}


def test_names_activity_and_categories(make_lines):
    lines = make_lines(
        {"product_code": " x1 ", "description": "RED TOY", "source": "source2", "invoice_date": "2011-06-01 10:00:00"},
        {"product_code": "X1", "description": " BLUE TOY ", "source": "source1", "invoice_date": "2011-05-01 10:00:00"},
        {"product_code": "X 1", "description": None, "invoice_date": "2011-12-01 10:00:00"},  # no name at all
        {"product_code": "edge", "description": "LAMP", "invoice_date": "2011-06-04 10:00:00"},  # exactly 180 days
        {"product_code": "late", "description": "LAMP", "invoice_date": "2011-06-04 09:59:59"},
        {"product_code": "undated", "description": "X", "invoice_date": None},
        {"product_code": "nan", "description": "X"}, {"product_code": None, "description": "X"},
    )
    assert records(catalogue.build_catalogue(lines)) == {
        "X1": ("BLUE TOY", "Juguetes", False),  # same count: the first export comes first
        "EDGE": ("LAMP", "Electronica", True),
        "LATE": ("LAMP", "Electronica", False),
        "UNDATED": ("X", "Varios", False),
    }


def test_most_frequent_name_wins(make_lines):
    lines = make_lines(*[{"product_code": "A", "description": d, "source": s}
                         for d, s in [("ONE", "source1"), ("TWO", "source2"), ("TWO", "source2")]])
    assert records(catalogue.build_catalogue(lines))["A"][0] == "TWO"


def test_no_input_gives_an_empty_catalogue(spark, make_lines):
    empty = catalogue.build_catalogue(make_lines({}).where("false"))
    assert empty.count() == 0
    assert catalogue.page_summary(empty).first() == (0, 1, 50, 1)
    assert catalogue.page_items(empty).count() == 0


@pytest.fixture(scope="module")
def five(spark):
    rows = [(f"C{n}", f"NAME {n}", "Hogar" if n % 2 else "Papeleria", "United Kingdom", n != 3) for n in range(5)]
    return spark.createDataFrame(rows, "code string, name string, category string, supplier_country string, is_active boolean")


def test_pages(five):
    assert catalogue.page_summary(five, 3, 2).first() == (5, 3, 2, 3)
    for page, codes in [(1, ["C0", "C1"]), (3, ["C4"]), (4, [])]:
        assert [r.code for r in catalogue.page_items(five, page, 2).collect()] == codes
    assert [r.code for r in catalogue.page_items(five, category="hogar", active_only=True).collect()] == ["C1"]
    assert [r.code for r in catalogue.page_items(five, 1, 9, "HOGAR").collect()] == ["C1", "C3"]


@pytest.mark.parametrize("page, size", [(0, 10), (1, 0), (1, 201)])
def test_page_limits(five, page, size):
    with pytest.raises(ValueError):
        catalogue.page_items(five, page, size)


def test_lookup(five):
    assert [r.name for r in catalogue.find_product(five, " c2 ").collect()] == ["NAME 2"]
    assert catalogue.find_product(five, "C9").count() == 0


def test_json_round_trip(spark, five, tmp_path):
    named = five.withColumnRenamed("name", "n").selectExpr("code", "concat(n, ' ñ') AS name", "category", "supplier_country", "is_active")
    path = str(tmp_path / "catalogue")
    catalogue.write_catalogue(named, path)
    assert any("ñ" in f.read_text(encoding="utf-8") for f in (tmp_path / "catalogue").glob("*.json"))
    assert sorted(catalogue.read_catalogue(spark, path).collect()) == sorted(named.collect())


def test_missing_column_is_an_error(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        source2_lines(spark.createDataFrame([("1",)], "Invoice string"))
