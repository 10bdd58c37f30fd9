import pytest

from checks.compare import difference, duck
from checks.oracle import oracle_sql
from checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, SF_DIR, name, connection) is None


def test_flagship_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.count() > 0 and result.columns[:4] == ["year", "month", "month_name", "periodo"]
