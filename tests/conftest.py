import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyline.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


LINE_SCHEMA = (
    "invoice_no string, product_code string, description string, quantity string, invoice_date string, "
    "unit_price string, customer_id string, country string, source string"
)


@pytest.fixture(scope="session")
def make_lines(spark):
    """Canonical lines from keyword arguments over a good default line."""
    good = {"invoice_no": "1", "product_code": "A1", "description": "MUG", "quantity": "2",
            "invoice_date": "2010-12-01 08:26:00", "unit_price": "1.5", "customer_id": "17850.0",
            "country": "France", "source": "source2"}

    def build(*changes: dict):
        rows = [tuple({**good, "invoice_no": str(n), **change}.values()) for n, change in enumerate(changes)]
        return spark.createDataFrame(rows, LINE_SCHEMA)

    return build
