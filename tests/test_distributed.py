"""Skew-safe building blocks against brute force, and the shape of plans."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from checks.inputs import inputs
from checks.queries import queries
from tallyline.functions import grouping
from tallyline.plans import business
from tallyline.functions.grouping import keep_first, subtract_copies, weighted_mode
from tallyline.functions.ranking import number_rows, percent_rank_desc, top_fraction_cut

SF_DIR = "/root/testdata/sf0.001"


def skewed_rows(seed, n=3000):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.4 else rng.choice([None, *"abcdefgh"]), rng.randrange(6), rng.choice([None, "x", "y"]))
            for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_and_rest_are_a_partition(spark, monkeypatch, seed):
    monkeypatch.setattr(grouping, "COPIES_PER_CHUNK", 7)  # hot copies need many chunks
    data = skewed_rows(seed)
    df = spark.createDataFrame(data, "k string, v int, w string").repartition(7)
    first = keep_first(df, ["k"], [F.col("v"), F.col("w").asc_nulls_last()])
    best = {}
    for k, v, w in data:
        best[k] = min(best.get(k, (99, True, "")), (v, w is None, w or ""))
    assert {r.k: (r.v, r.w) for r in first.collect()} == {k: (v, w or None) for k, (v, _, w) in best.items()}
    rest = Counter(tuple(r) for r in subtract_copies(df, first).collect())
    assert rest + Counter(tuple(r) for r in first.collect()) == Counter(data)


@pytest.mark.parametrize("hot", [50, 10**9])
def test_marked_rows_are_first_and_rest(spark, monkeypatch, hot):
    monkeypatch.setattr(grouping, "HOT_ROWS", hot)
    monkeypatch.setattr(grouping, "COPIES_PER_CHUNK", 7)
    order = [F.col("v"), F.col("w").asc_nulls_last()]
    data = skewed_rows(6)
    df = spark.createDataFrame(data, "k string, v int, w string").repartition(7)
    assert (len(grouping.hot_keys(df, ["k"])) > 0) == (hot == 50)
    marked = grouping.mark_rest(df, ["k"], order, "rest").collect()
    first = Counter(tuple(r) for r in keep_first(df, ["k"], order).collect())
    assert Counter(tuple(r)[:3] for r in marked if not r.rest) == first
    assert Counter(tuple(r)[:3] for r in marked) == Counter(data)


def test_mode_matches_brute_force(spark):
    data = [(k, str(v)) for k, v, _ in skewed_rows(4)]
    df = spark.createDataFrame(data, "k string, v string")
    counts = Counter(data)
    expected = {}
    for (k, v), n in counts.items():
        expected[k] = min(expected.get(k, (0, "")), (-n, v))
    got = {r.k: r.m for r in weighted_mode(df, ["k"], "v", F.lit(1), "m").collect()}
    assert got == {k: v for k, (_, v) in expected.items()}


@pytest.mark.parametrize("values", [[5], [1, 1, 1], [3, 1, 2, 2, 9, 9, 0], list(range(500)), [0] * 300 + list(range(200))])
def test_percent_rank_equals_builtin(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    builtin = {r.v: r.p for r in df.withColumn("p", F.percent_rank().over(W.orderBy(F.desc("v")))).collect()}
    assert {r.v: r.percent_rank for r in percent_rank_desc(df, "v").collect()} == builtin
    for fraction in (0.0, 0.2, 0.3, 1.0):
        cut = top_fraction_cut(df, "v", fraction).first().cut
        assert cut == min(v for v, p in builtin.items() if p <= fraction)


def test_row_numbers(spark):
    codes = [f"C{n:04d}" for n in random.Random(5).sample(range(5000), 1200)]
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(5)
    got = {r.code: r.position for r in number_rows(df, [F.col("code")]).collect()}
    assert got == {c: n for n, c in enumerate(sorted(codes))}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_python_and_no_product(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    # the seed is one constant row: Catalyst folds its key, which leaves a join with that row
    products = [] if name == "anonymous_seed" else ["BroadcastNestedLoopJoin"]
    for bad in ("Python", "Pandas", "CartesianProduct", *products):
        assert bad not in plan


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = plan_of(inputs(spark, SF_DIR).unique)
    assert "row_number(), 1, Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_rule_chain_does_not_shuffle(spark):
    from tallyline.operators.cleaning import check_lines

    data = inputs(spark, SF_DIR)
    assert "Exchange" not in plan_of(check_lines(data.source2))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(business.country_totals(inputs(spark, SF_DIR).facts))
    assert "EqualTo(transaction_type,SALE)" in plan
    assert "source_row_hash" not in plan


@pytest.fixture
def no_broadcast(spark):
    """Joins as on large tables, with thresholds that make the test data large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_key():
    return F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), (F.xxhash64("id") % 5000).cast("string")))


def final_plan(df):
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_hot_keys_of_joins_are_split(spark, no_broadcast):
    from tallyline.operators.cleaning import fill_description
    from tallyline.plans.business import customer_type_totals
    from tallyline.session import stage

    base = spark.range(0, 400_000, 1, 16)
    # Only lines without a description are exchanged; their invoice numbers give the hot key its size.
    lines = stage(base.select(hot_key().alias("code_key"), F.xxhash64("id").alias("invoice_no"),
                              F.when(F.col("id") % 2 == 0, F.concat(F.lit("D"), F.col("id"))).alias("description")), "hot-lines")
    names = stage(lines.groupBy("code_key").agg(F.max("description").alias("fill_name")), "hot-names")
    filled = fill_description(lines, names).agg(F.count("*").alias("n"), F.max("description").alias("d"), F.max("invoice_no").alias("i"))
    assert "skew=true" in final_plan(filled)
    assert filled.first().n == 400_000

    sold = stage(base.select(hot_key().alias("customer_id"), F.concat(F.lit("I"), F.col("id")).alias("invoice_no"),
                             F.lit("SALE").alias("transaction_type"), F.lit(1).cast("decimal(14,4)").alias("gross_revenue")), "hot-facts")
    known = stage(sold.select("customer_id").distinct().withColumn("is_anonymous", F.col("customer_id") == "HOT"), "hot-customers")
    totals = customer_type_totals(sold, known)
    assert "skew=true" in final_plan(totals)
    assert {r.is_anonymous: r.num_facturas for r in totals.collect()} == {True: 133_334, False: 266_666}
