"""Headline timings as one JSON line.

``raw_to_q1`` is the whole chain: raw lines -> unique -> checked -> facts -> rollup -> monthly net
sales; ``raw_to_q1_again`` repeats it from the raw lines in the same, now warm JVM. ``complete_load`` is a daily run from CSV files into all warehouse tables. The other entries
run on the tables that the first one prepared. Every result is fully computed
and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks.inputs import Inputs
from checks.queries import _QUERIES, plain
from tallyline.plans import daily_run
from tallyline.schemas import SOURCE1_COLUMNS, SOURCE2_COLUMNS

HEADLINE = [
    "q1_monthly_net_sales", "q2_category_revenue", "q3a_top_net_revenue", "q3b_top_return_rate",
    "q4_countries", "q5_anonymous_vs_identified", "q6a_unique_codes", "q6b_undescribed_products",
    "q6c_blank_names", "q7_recommendation", "q7_alerts", "dedup_keep_first", "duplicates_log",
    "rejects_by_reason", "fill_description", "canonical_name", "row_hash", "fact_transactions",
    "daily_revenue", "insert_transactions", "upsert_daily_revenue", "idempotent_rerun", "null_report",
    "quantity_histogram", "description_variants", "duplicate_profile", "overlapping_invoices", "build_catalog",
    "catalog_page", "fk_orphans",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def complete_load(spark: SparkSession, data: Inputs) -> None:
    """Both exports from CSV files into all warehouse tables; writing the CSV files is not timed apart."""
    with tempfile.TemporaryDirectory(prefix="bench-") as root:
        for name, raw, columns, encoding in (("one", data.raw1, SOURCE1_COLUMNS, "ISO-8859-1"), ("two", data.raw2, SOURCE2_COLUMNS, "UTF-8")):
            raw.select(list(columns)).write.option("header", True).option("encoding", encoding).option("escape", '"').option(
                "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}")
        daily_run.run(spark, f"{root}/one", f"{root}/two", f"{root}/warehouse", "bench", "2001-12-31",
                      first_day="1995-01-01", last_day="2001-12-31")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = Inputs(spark, os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001"))
    plain(_QUERIES["q1_monthly_net_sales"](warm)).write.format("noop").mode("overwrite").save()

    data = Inputs(spark, sf_dir)
    stages = {"stage_raw_exports": timed(lambda: (data.raw1, data.raw2))}
    lines = data.raw1.count() + data.raw2.count()

    def noop(name: str, inputs: Inputs = data) -> None:
        plain(_QUERIES[name](inputs)).write.format("noop").mode("overwrite").save()

    stages["raw_to_q1"] = timed(lambda: noop("q1_monthly_net_sales"))
    again = Inputs(spark, sf_dir)
    again.raw1, again.raw2 = data.raw1, data.raw2
    stages["raw_to_q1_again"] = timed(lambda: noop("q1_monthly_net_sales", again))
    stages["stage_dimensions"] = timed(lambda: (data.products, data.customers))
    stages["complete_load"] = timed(lambda: complete_load(spark, data))
    times = {name: timed(lambda: noop(name)) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()) + sum(stages.values()), 3),
        "unit": "sec", "queries": {**stages, **times}, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "raw_lines": lines, "records_per_sec_raw_to_q1": round(lines / stages["raw_to_q1"]),
        "records_per_sec_raw_to_q1_again": round(lines / stages["raw_to_q1_again"]),
    }))


if __name__ == "__main__":
    sys.exit(main())
