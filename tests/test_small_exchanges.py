"""What large runs write and exchange: facts without a second copy, shared joins, tables only where they are asked for."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.inputs import RAW_SOURCE1, RETAIL_BASE, Inputs
from tallyline.operators import cleaning, facts, quality
from tallyline.session import stage

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines_with_equal_hashes(make_lines):
    """Three raw codes of one product give one hash; another invoice has its own."""
    codes = ["A1", " a1 ", "a 1", "B1"]
    return cleaning.accepted(cleaning.check_lines(make_lines(
        *[{"invoice_no": "1", "product_code": code, "unit_price": price} for code, price in zip(codes, ["3", "1", "2", "4"], strict=True)],
        {"invoice_no": "2"}, {"invoice_no": None}, {"invoice_no": None, "product_code": "a1"})))


@pytest.mark.parametrize("few", [100, 1, 0])
def test_one_fact_per_hash(spark, make_lines, monkeypatch, few):
    monkeypatch.setattr(facts, "FEW_REPEATED", few)
    lines = lines_with_equal_hashes(make_lines)
    kept = facts.distinct_facts(facts.fact_transactions(lines))
    assert sorted((r.invoice_no or "", r.product_code, int(r.unit_price * 2)) for r in kept.collect()) == [
        ("", "A1", 3), ("1", "A1", 2), ("1", "B1", 8), ("2", "A1", 3)]
    narrowed = facts.fact_transactions(facts.lines_of_facts(lines, ["invoice_no", "product_code_raw", "quantity_raw"]))
    assert sorted(map(str, narrowed.collect())) == sorted(map(str, kept.collect()))


def test_facts_with_their_own_hash_are_not_exchanged(spark, make_lines):
    lines = stage(cleaning.accepted(cleaning.check_lines(make_lines({}, {}, {}))), "own-hashes")
    assert "Exchange" not in plan(facts.distinct_facts(facts.fact_transactions(lines)))


def test_exports_are_filters_on_tables_joined_once(spark):
    data = Inputs(spark, SF_DIR)
    for df in (data.raw1, data.raw2, data.source1, data.source2):
        assert "Join" not in plan(df) and "Exchange" not in plan(df)
    tables = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("lineitem", "orders", "customer", "part", "nation")}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    spark.sql(RETAIL_BASE).createOrReplaceTempView("retail_base")
    as_written = spark.sql(RAW_SOURCE1)
    assert as_written.exceptAll(data.raw1).isEmpty() and data.raw1.exceptAll(as_written).isEmpty()


def test_duplicates_come_with_the_checked_lines(spark):
    data = Inputs(spark, SF_DIR)
    for df in (data.checked, data.duplicates):
        assert "Exchange" not in plan(df) and "Window" not in plan(df)
    assert "rejected" not in data.__dict__ and data.duplicates.count() + data.checked.count() == data.combined.count()


def test_repeated_keys_are_looked_for_by_short_hashes(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), ("b", None), ("c", None), ("c", None)]
    table = spark.createDataFrame(rows, "x string, y int")
    found = quality.repeated_keys(table, ["x", "y"])
    assert sorted(map(str, found.collect())) == sorted(map(str, table.groupBy("x", "y").count().where("count > 1").select("x", "y").collect()))
    own = quality.repeated_keys(table.distinct(), ["x", "y"])
    assert own.count() == 0 and "Exchange" not in plan(own)


def test_a_load_takes_its_facts_from_the_staged_lines(spark):
    data = Inputs(spark, SF_DIR)
    lines = facts.fact_transactions(data.valid)
    brought = queries._part(data, lines.where("year(date_id) <= 1996"))
    assert "Exchange" not in plan(brought.facts) and set(brought.facts.inputFiles()) <= set(data.valid.inputFiles())
    assert brought.extracted == brought.facts.count() > 0


def test_a_check_builds_only_its_tables(spark):
    data = Inputs(spark, SF_DIR)
    assert quality.fk_orphans(data.tables).count() == 5
    assert "rejected" not in data.__dict__ and set(data.tables) >= {"log_rejected_records", "log_pipeline_runs"}


def test_shuffle_files_leave_with_their_write(spark):
    def left():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = left()
    df = spark.range(20_000).groupBy((F.col("id") % 7000).alias("k")).count()
    assert stage(df, "shuffled").count() == 7000
    assert len(left() - before) <= 2  # the count's own
    assert df.count() == 7000
