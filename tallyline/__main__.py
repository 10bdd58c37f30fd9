"""Command line: ``spark-submit`` or ``python -m tallyline <command> …``.

run        load two CSV exports into the warehouse folder
report     print one business result from the warehouse folder
sql        run a SQL statement over the warehouse tables
catalogue  write the product catalogue of the two exports as JSON lines
profile    print one profiling report of the two exports
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import catalogue, ingest, profiling
from tallyline.plans import business, daily_run
from tallyline.plans.daily_run import Warehouse
from tallyline.schemas import SOURCE1_COLUMNS, SOURCE2_COLUMNS
from tallyline.session import prepare, stage, staging_area
from tallyline.sources.keywords import PIPELINE_KEYWORDS, read_keyword_map
from tallyline.sources.lines import read_csv_text, read_source1, read_source2, text_lines

PROFILES = ["null_report", "quantity_profile", "quantity_histogram", "price_profile", "date_profile", "source_overlap",
            "monthly_counts", "customer_profile", "duplicate_profile", "overlapping_invoices", "most_varied_codes",
            "variant_summary", "variants_of_top_code", "nonnumeric_codes", "country_profile", "sample", "zero_price_sample"]


def report(warehouse: Warehouse, name: str) -> DataFrame:
    daily, facts = warehouse.daily, warehouse.facts
    products = warehouse.products
    reports = {
        "q1": lambda: business.monthly_net_sales(daily()),
        "q2": lambda: business.category_revenue(daily(), products()),
        "q3a": lambda: business.top_net_revenue(daily(), products()),
        "q3b": lambda: business.top_return_rate(daily(), products()),
        "q4": lambda: business.country_report(business.country_totals_of_months(warehouse.monthly_sales())),
        "q5": lambda: business.customer_type_report(business.customer_type_totals_of_months(warehouse.monthly_sales())),
        "q6a": lambda: business.unique_codes(products()),
        "q6b": lambda: business.undescribed_products(products(), facts()),
        "q6c": lambda: business.blank_names(products(), facts()),
        "q7": lambda: business.recommendation(daily(), products()),
        "alerts": lambda: business.alerts(daily(), products()),
    }
    return reports[name]()


def print_rows(df: DataFrame) -> None:
    """All rows, one a line with tabs between the cells; fetched a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if cell is None else str(cell) for cell in row))


def profile(spark: SparkSession, source1: str, source2: str, name: str, multi_line: bool = False) -> DataFrame:
    """Reports that look at one export use the first one."""
    first = text_lines(read_csv_text(spark, source1, list(SOURCE1_COLUMNS), "ISO-8859-1", multi_line), SOURCE1_COLUMNS, "source1")
    second = text_lines(read_csv_text(spark, source2, list(SOURCE2_COLUMNS), multi_line=multi_line), SOURCE2_COLUMNS, "source2")
    of_first = {"most_varied_codes", "variant_summary", "variants_of_top_code", "nonnumeric_codes", "country_profile",
                "sample", "zero_price_sample"}
    return getattr(profiling, name)(first if name in of_first else first.unionByName(second))


def build_catalogue(spark: SparkSession, source1: str | None, source2: str | None, out: str, multi_line: bool = False) -> None:
    with staging_area(spark):
        parts = [stage(read(spark, path, multi_line), "catalogue-lines")
                 for read, path in ((read_source1, source1), (read_source2, source2)) if path]
        lines = ingest.combine_sources(*parts).drop("source_priority") if len(parts) == 2 else parts[0]
        catalogue.write_catalogue(catalogue.build_catalogue(lines), out)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyline", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("run")
    for name in ("source1", "source2", "warehouse", "run-id", "date"):
        load.add_argument(f"--{name}", required=True)
    load.add_argument("--keywords", help="JSON keyword map")
    load.add_argument("--catalogue", help="catalogue folder for the categories")
    result = commands.add_parser("report")
    result.add_argument("name", choices=["q1", "q2", "q3a", "q3b", "q4", "q5", "q6a", "q6b", "q6c", "q7", "alerts"])
    statement = commands.add_parser("sql")
    statement.add_argument("text")
    for command in (result, statement):
        command.add_argument("--warehouse", required=True)
    export = commands.add_parser("catalogue")
    export.add_argument("--source1")
    export.add_argument("--source2")
    export.add_argument("--out", required=True)
    look = commands.add_parser("profile")
    look.add_argument("name", choices=PROFILES)
    look.add_argument("--source1", required=True)
    look.add_argument("--source2", required=True)
    for command in (load, result, statement):
        command.add_argument("--first-day", default="2009-01-01")
        command.add_argument("--last-day", default="2012-12-31")
    for command in (load, export, look):
        command.add_argument("--multi-line", action="store_true", help="cells may hold quoted line breaks")
    options = parser.parse_args(arguments)
    if options.command == "catalogue" and not (options.source1 or options.source2):
        parser.error("catalogue needs --source1 or --source2")

    spark = prepare(SparkSession.builder.appName("tallyline").getOrCreate())
    if options.command == "run":
        keywords = read_keyword_map(spark, options.keywords) if options.keywords else PIPELINE_KEYWORDS
        known = catalogue.read_catalogue(spark, options.catalogue) if options.catalogue else None
        print(daily_run.run(spark, options.source1, options.source2, options.warehouse, options.run_id, options.date,
                            keywords, known, options.first_day, options.last_day, options.multi_line))
    elif options.command == "catalogue":
        build_catalogue(spark, options.source1, options.source2, options.out, options.multi_line)
    elif options.command == "profile":
        print_rows(profile(spark, options.source1, options.source2, options.name, options.multi_line))
    else:
        warehouse = Warehouse(spark, options.warehouse, options.first_day, options.last_day)
        if options.command == "report":
            print_rows(report(warehouse.pin(), options.name))
        else:
            warehouse.register_views()
            print_rows(spark.sql(options.text))


if __name__ == "__main__":
    main()
