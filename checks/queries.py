"""One query per operator over the given tables. Names match ``checks.oracle``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import FIRST_DAY, HOME_COUNTRY, KEYWORDS, LAST_DAY, Inputs, inputs
from tallyline.functions import dates
from tallyline.operators import (
    catalogue, categories, cleaning, dimensions, facts, ingest, profiling, quality, rejects, upserts,
)
from tallyline.plans import business, daily_run, metrics
from tallyline.plans.daily_run import Cleaned, Warehouse
from tallyline.plans.tables import append_by_month, read_table
from tallyline.schemas import (
    BAD_PRICE, CANONICAL_COLUMNS, FACT_TRANSACTIONS, NO_CODE, NO_DESCRIPTION, NOT_NUMERIC, SOURCE1_COLUMNS, SOURCE2_COLUMNS,
)
from tallyline.session import stage, staging_root
from tallyline.sources.keywords import PIPELINE_KEYWORDS, read_keyword_map
from tallyline.sources.lines import read_source1, read_source2, yearly_union

Query = Callable[[Inputs], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Column types that both engines print alike: no timestamps, no small integers."""
    def cast(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = dates.iso_text(column)
        elif isinstance(field.dataType, T.ShortType):
            column = column.cast("int")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast(f"decimal(38,{field.dataType.scale})")
        return column.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def _count(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_lines"))


def _yearly(i: Inputs) -> DataFrame:
    """A sheet for each year of the lines, and a last one for lines without a date."""
    sheeted = stage(i.source2.withColumn("sheet_year", F.year(F.to_date("invoice_date"))), "sheets", ["sheet_year"])
    years = [r[0] for r in sheeted.select("sheet_year").distinct().orderBy(F.asc_nulls_last("sheet_year")).collect()]
    year = F.col("sheet_year")
    sheets = [sheeted.where(year.isNull() if y is None else year == y) for y in years]
    return yearly_union(sheets).groupBy("sheet", "sheet_year").agg(
        F.count("*").alias("n_lines"), F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"))


def _parsed_dates(i: Inputs) -> DataFrame:
    iso1 = dates.iso_text(dates.source_timestamp(F.col("invoice_date"), dates.SOURCE1_FORMAT))
    iso2 = dates.iso_text(dates.source_timestamp(F.col("invoice_date"), dates.SOURCE2_FORMAT))
    both = i.text1.withColumn("iso_date", iso1).unionByName(i.text2.withColumn("iso_date", iso2))
    return _count(both, "source", F.col("invoice_date").alias("date_text"), "iso_date")


def _numbers(i: Inputs) -> DataFrame:
    texts = i.unique.withColumns({"quantity_text": F.col("quantity"), "unit_price_text": F.col("unit_price")})
    return _count(cleaning.coerce_numbers(texts), "quantity_text", "quantity", "unit_price_text", "unit_price")


def _texts(i: Inputs) -> DataFrame:
    """Unique lines with raw and cleaned code, description and customer side by side."""
    raw = i.unique.select(F.col("product_code").alias("raw_code"), F.col("description").alias("raw_description"),
                          F.col("customer_id").alias("raw_customer"), "product_code", "description", "customer_id")
    return raw.transform(cleaning.normalize_codes).transform(cleaning.blank_descriptions).transform(
        cleaning.normalize_customers)


def _normal_dates(i: Inputs) -> DataFrame:
    dated = cleaning.normalize_dates(i.unique)
    return _count(dated, "invoice_date", dates.iso_text_utc(F.col("invoice_ts")).alias("invoice_date_utc"), "date_id")


def _tagged(i: Inputs) -> DataFrame:
    lines = i.unique.transform(cleaning.coerce_numbers).transform(cleaning.tag_transaction_type)
    return _count(lines, F.col("quantity").cast("bigint").alias("quantity"), "transaction_type")


def _both_category_modes(i: Inputs) -> DataFrame:
    parts = [
        categories.assign_category(i.names, KEYWORDS, table).select(F.lit(mode).alias("mode"), "product_code", "category")
        for mode, table in (("catalogue", i.catalogue), ("keywords", i.catalogue.where("code IS NULL")))
    ]
    return parts[0].unionByName(parts[1])


def _transformation(i: Inputs) -> DataFrame:
    """All rows of the four outputs as key and content."""
    result = cleaning.run_transformation(i.combined, KEYWORDS)

    def listed(output: str, df: DataFrame, key: str, *content: str) -> DataFrame:
        return df.select(F.lit(output).alias("output"), F.col(key).alias("key"),
                         F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content]).alias("content"))

    parts = [
        listed("valid", facts.hashed(result.lines), "source_row_hash", "invoice_no", "customer_id", "transaction_type", "country"),
        listed("products", result.products, "product_code", "canonical_name", "category"),
        listed("customers", result.customers, "customer_id", "is_anonymous"),
        listed("rejected", result.rejected, "rejection_reason", "invoice_no", "product_code", "description", "source"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _anonymous_seed(i: Inputs) -> DataFrame:
    seed = dimensions.anonymous_customer(i.spark, FIRST_DAY, LAST_DAY)
    return upserts.insert_customers(seed, i.customers)


def _calendar_use(i: Inputs) -> DataFrame:
    used = i.facts.groupBy("date_id").agg(F.count("*").alias("n"))
    return i.calendar.join(used, "date_id", "left").withColumn("n_lines", F.coalesce("n", F.lit(0))).drop("n")


def _upserted_products(i: Inputs) -> DataFrame:
    """Two thirds of the products are known under old names, two thirds come in again."""
    third = F.substring("product_code", 2, 20).cast("bigint") % 3
    before, now = F.lit("2000-01-01").cast("timestamp"), F.lit("2001-01-01").cast("timestamp")
    known = i.products.where(third != 0).select(
        "product_code", F.lit("OLD NAME").alias("canonical_name"), F.lit("OLD").alias("category"),
        F.lit(True).alias("is_active"), before.alias("created_at"), before.alias("updated_at"))
    merged = upserts.upsert_products(known, i.products.where(third != 1), now)
    return merged.select("product_code", "canonical_name", "category", "is_active",
                         (F.col("created_at") == before).alias("was_known"),
                         (F.col("updated_at") == now).alias("was_updated"))


def _inserted_customers(i: Inputs) -> DataFrame:
    even = F.coalesce(F.col("customer_id").try_cast("bigint") % 2 == 0, F.lit(False))
    known = i.customers.where(even).select("customer_id", "is_anonymous",
                                           F.lit("1995-01-01").cast("date").alias("first_seen_at"))
    return upserts.insert_customers(known, i.customers)


def _inserted_transactions(i: Inputs) -> DataFrame:
    """The facts up to 1997 are loaded already; all lines come in."""
    incoming = facts.fact_transactions(i.valid)
    new = upserts.new_transactions(i.facts.where("year(date_id) <= 1997"), incoming)
    arrived = incoming.groupBy("transaction_type").agg(F.count("*").alias("incoming"))
    inserted = new.groupBy("transaction_type").agg(F.count("*").alias("inserted"))
    return arrived.join(inserted, "transaction_type")


def _upserted_daily(i: Inputs) -> DataFrame:
    """The rollup from 1998 on replaces an older state of the whole rollup."""
    old = i.daily.withColumn("net_revenue", F.lit(-1).cast("decimal(38,4)")).withColumn("sale_count", F.lit(0).cast("bigint"))
    merged = upserts.upsert_daily_revenue(old, i.daily.where("year(date_id) >= 1998"))
    return merged.select("date_id", "product_code", "country", "net_revenue", "sale_count")


def _rerun(i: Inputs) -> DataFrame:
    """Load the same lines again: no new facts, and no change in the rollup."""
    new = stage(upserts.new_transactions(i.facts, facts.fact_transactions(i.valid)), "rerun")
    again = facts.daily_revenue(i.facts.unionByName(new))
    before = i.daily.select(again.columns)
    # Rows of either side that the other lacks, each as often as it is there too often; both are exchanged once.
    signed = again.withColumn("_n", F.lit(1)).unionByName(before.withColumn("_n", F.lit(-1)))
    changed = signed.groupBy(*before.columns).agg(F.abs(F.sum("_n")).alias("_n"))
    return new.agg(F.count("*").alias("new_facts")).withColumn(
        "changed_rollup_rows", changed.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar())


_warehouses: dict[tuple[str, str], Warehouse] = {}
_LOADS = {"a": "year(date_id) <= 1996", "b": "year(date_id) BETWEEN 1995 AND 1998", "c": "true"}


def _loaded(i: Inputs) -> Warehouse:
    """A warehouse after three loads that overlap, each published as a whole; made once."""
    key = (i.spark.sparkContext.applicationId, i.sf_dir)
    if key in _warehouses:
        return _warehouses[key]
    warehouse = Warehouse(i.spark, f"{staging_root(i.spark)}/warehouse-{uuid.uuid4().hex[:12]}", FIRST_DAY, LAST_DAY)
    lines = facts.fact_transactions(i.valid)
    for run_id, part in _LOADS.items():
        daily_run.load(warehouse, _part(i, lines.where(part)), run_id, "2001-12-31")
    _warehouses[key] = warehouse
    return warehouse


def _part(i: Inputs, lines: DataFrame) -> Cleaned:
    return Cleaned(i.products, i.customers, lines, i.rejected, lines.count())


def _rollup_by_deltas(i: Inputs) -> DataFrame:
    """The rollup to which each load has added its new facts, and the load that changed each row last."""
    return _loaded(i).daily().drop("updated_at", "month")


def _loads_logged(i: Inputs) -> DataFrame:
    return _loaded(i).runs().select("run_id", "status", "records_extracted", "records_loaded", "records_rejected")


def _countries_of_months(i: Inputs, n: int) -> DataFrame:
    """The country report from the bitmaps that the loads have kept: no fact is read."""
    return business.country_report(business.country_totals_of_months(_loaded(i).monthly_sales()), n)


def _customers_of_months(i: Inputs) -> DataFrame:
    return business.customer_type_report(business.customer_type_totals_of_months(_loaded(i).monthly_sales()))


def _unpublished_load(i: Inputs) -> DataFrame:
    """What readers see of the facts of each year after one load, while a second one has written everything
    but is not published; and after a third one, which found nothing of it."""
    warehouse = Warehouse(i.spark, f"{staging_root(i.spark)}/warehouse-{uuid.uuid4().hex[:12]}", FIRST_DAY, LAST_DAY)
    lines = facts.fact_transactions(i.valid)
    daily_run.load(warehouse, _part(i, lines.where(_LOADS["a"])), "a", "2001-12-31")
    every = _part(i, lines)
    daily_run.prepare_load(warehouse.pin(), every, "broken", "2001-12-31")

    def seen(at: str) -> DataFrame:
        by_year = lambda df: df.groupBy(F.year("date_id").alias("year"))
        stored = by_year(warehouse.facts()).agg(F.count("*").alias("facts"))
        rolled = by_year(warehouse.daily()).agg(F.sum(F.col("sale_count") + F.col("return_count")).alias("rolled_up"))
        return stage(stored.join(rolled, "year").select(F.lit(at).alias("seen"), "year", "facts", "rolled_up"), "seen")

    during = seen("while it is not published")
    daily_run.load(warehouse, every, "again", "2001-12-31")
    return during.unionByName(seen("after the next load"))


def _run_row(i: Inputs) -> DataFrame:
    return i.run_row.drop("started_at", "finished_at", "notes")


def _nameless(i: Inputs) -> DataFrame:
    """Products whose placeholder name counts as no name."""
    return i.products.withColumn("canonical_name", F.nullif("canonical_name", F.lit(NO_DESCRIPTION)))


def _csv_roundtrip(i: Inputs) -> DataFrame:
    """Both exports with null tokens, quotes and line breaks in their cells, written as CSV and read back."""
    root = f"{staging_root(i.spark)}/csv-{uuid.uuid4().hex[:12]}"

    def written(raw: DataFrame, headers: dict[str, str], encoding: str, name: str) -> str:
        code = F.col(next(h for h, c in headers.items() if c == "product_code"))
        told = F.when(code.endswith("7"), F.concat(F.lit('a "b", '), "Description", F.lit("\nc"))).when(
            code.endswith("5"), F.lit("n/a")).otherwise(F.col("Description"))
        raw.select(list(headers)).withColumn("Description", told).write.option("header", True).option("encoding", encoding).option(
            "quote", '"').option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}")
        return f"{root}/{name}"

    first = read_source1(i.spark, written(i.raw1, SOURCE1_COLUMNS, "ISO-8859-1", "source1"), multi_line=True)
    second = read_source2(i.spark, written(i.raw2, SOURCE2_COLUMNS, "UTF-8", "source2"), multi_line=True)
    return _lines(first.unionByName(second))


def _keyword_file(i: Inputs) -> DataFrame:
    """Categories by a keyword map that was written as JSON and read back."""
    path = f"{staging_root(i.spark)}/keywords-{uuid.uuid4().hex[:12]}"
    text = json.dumps({"categories": KEYWORDS.categories, "default": KEYWORDS.default}, ensure_ascii=False)
    i.spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    return categories.category_by_keyword(i.names, read_keyword_map(i.spark, path))


def _catalogue_file(i: Inputs) -> DataFrame:
    path = f"{staging_root(i.spark)}/catalogue-{uuid.uuid4().hex[:12]}"
    catalogue.write_catalogue(i.catalogue, path)
    return catalogue.read_catalogue(i.spark, path)


def _appended_facts(i: Inputs) -> DataFrame:
    """The facts up to 1997 and the later ones, appended one after the other to a table by month."""
    path = f"{staging_root(i.spark)}/facts-{uuid.uuid4().hex[:12]}"
    for part in ("year(date_id) <= 1997", "year(date_id) > 1997"):
        append_by_month(i.facts.where(part), path)
    return read_table(i.spark, path, FACT_TRANSACTIONS, "month")


def _revenue_invariant(i: Inputs) -> DataFrame:
    """Gross sales by month, by category, by customer type and by line are the same sum."""
    sums = {
        "months": (business.monthly_totals(i.daily), "gross_sales"),
        "categories": (business.category_totals(i.daily, i.products), "gross_sales"),
        "customer types": (business.customer_type_totals(i.facts, i.customers), "revenue"),
        "lines": (i.facts.where("transaction_type = 'SALE'"), "gross_revenue"),
    }
    rows = [df.agg(F.sum(column).cast("decimal(38,4)").alias("gross_sales")).select(F.lit(name).alias("grouping"), "gross_sales")
            for name, (df, column) in sums.items()]
    return reduce(DataFrame.unionByName, rows)


def _mixed_dates(i: Inputs) -> DataFrame:
    """Order dates written in a layout that depends on the order, and read by the general parse."""
    layouts = ["yyyy/MM/dd", "dd-MMM-yyyy", "MMM d, yyyy", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss'Z'", "d MMMM yyyy"]
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("d"))
    text = F.coalesce(*[F.when(F.col("o_orderkey") % len(layouts) == n, F.date_format("d", layout)) for n, layout in enumerate(layouts)])
    return orders.select("o_orderkey", dates.iso_text(dates.general_timestamp(text)).alias("iso_date"))


_PAGE = {"page": 2, "size": 50, "category": "varios", "active_only": True}


def _deep_page(i: Inputs) -> DataFrame:
    return catalogue.page_items(i.catalogue, page=3, size=200)


def _months(i: Inputs) -> DataFrame:
    return business.monthly_totals(i.daily)


def _lines(df: DataFrame) -> DataFrame:
    return df.select(*CANONICAL_COLUMNS)


_QUERIES: dict[str, Query] = {
    # sources and ingestion
    "src1_canonical": lambda i: i.source1,
    "src2_canonical": lambda i: i.source2,
    "yearly_union": _yearly,
    "parse_dates_by_source": _parsed_dates,
    "combine_sources": lambda i: i.combined,
    "csv_roundtrip": _csv_roundtrip,
    "mixed_date_layouts": _mixed_dates,
    "dedup_keep_first": lambda i: _lines(i.unique),
    "duplicates_log": lambda i: i.duplicates.select(*CANONICAL_COLUMNS, "rejection_reason"),
    "dedup_counts": lambda i: ingest.dedup_counts(i.combined),
    # cleaning
    "coerce_numeric": _numbers,
    "reject_non_numeric": lambda i: i.checked.where(F.col("reject_reason") == NOT_NUMERIC).select(
        "invoice_no", F.col("product_code_raw").alias("product_code"), "source"),
    "reject_blank_code": lambda i: i.checked.where(F.col("reject_reason") == NO_CODE).select(
        "invoice_no", F.col("description_raw").alias("description"), "source"),
    "fill_description": lambda i: cleaning.fill_description(cleaning.past_code_rule(i.checked), i.fill_names).select(
        "invoice_no", "code_key", "description", "source"),
    "upper_description": lambda i: _count(_texts(i), "raw_description", F.upper("description").alias("description")),
    "normalize_codes": lambda i: _count(_texts(i), "raw_code", "code_key", "product_code"),
    "normalize_dates": _normal_dates,
    "assign_category_keyword": lambda i: categories.category_by_keyword(i.names, KEYWORDS),
    "assign_category_keyword_default_map": lambda i: categories.category_by_keyword(i.names, PIPELINE_KEYWORDS),
    "assign_category_catalog": lambda i: categories.category_by_catalogue(i.names, i.catalogue),
    "assign_category": _both_category_modes,
    "keyword_file": _keyword_file,
    "normalize_customer": lambda i: _count(_texts(i), "raw_customer", "customer_id"),
    "tag_transaction_type": _tagged,
    "count_by_type": lambda i: rejects.count_by_type(i.checked),
    "reject_bad_price": lambda i: i.checked.where(F.col("reject_reason") == BAD_PRICE).select(
        "invoice_no", "product_code", F.col("quantity").cast("bigint").alias("quantity"), "source"),
    "gross_revenue": lambda i: i.valid.select(
        "invoice_no", "product_code", F.col("quantity").cast("bigint").alias("quantity"),
        F.col("gross_revenue").cast("decimal(38,4)").alias("gross_revenue"), "source"),
    "canonical_name": lambda i: i.valid.join(i.names, "product_code", "left").select(
        "invoice_no", "product_code", "canonical_name", "source"),
    "mode_per_group": lambda i: cleaning.fill_names(i.checked),
    "row_hash": lambda i: facts.hashed(i.valid).select("invoice_no", "product_code", "source", "source_row_hash"),
    "fill_country": lambda i: _count(i.valid, "country"),
    "cut_quantities": lambda i: facts.cut_quantities(i.valid),
    "run_transformation": _transformation,
    # rejects, counters, run log
    "rejected_rows": lambda i: i.rejected,
    "rejects_by_reason": lambda i: rejects.rejects_by_reason(i.rejected),
    "reject_log_json": lambda i: i.reject_log,
    "run_log": _run_row,
    "pipeline_counts": lambda i: rejects.pipeline_counts(i.checked, ingest.dedup_counts(i.combined), i.products),
    "table_counts": lambda i: rejects.table_counts({k: t for k, t in i.tables.items() if k != "dim_date"}),
    "anonymous_impact": lambda i: rejects.anonymous_impact(i.checked),
    "null_description_impact": lambda i: rejects.null_description_impact(cleaning.past_code_rule(i.checked)),
    # dimensions and facts
    "dim_products": lambda i: dimensions.products(categories.category_by_keyword(i.names, KEYWORDS)),
    "dim_customers": lambda i: dimensions.seen_range(dimensions.customers(i.valid), i.facts),
    "dim_date": _calendar_use,
    "anonymous_seed": _anonymous_seed,
    "fact_transactions": lambda i: facts.distinct_facts(facts.fact_transactions(i.valid)),
    "append_facts": _appended_facts,
    "revenue_invariant": _revenue_invariant,
    "daily_revenue": lambda i: facts.daily_revenue(i.facts),
    "upsert_products": _upserted_products,
    "insert_customers": _inserted_customers,
    "insert_transactions": _inserted_transactions,
    "upsert_daily_revenue": _upserted_daily,
    "idempotent_rerun": _rerun,
    "rollup_by_deltas": _rollup_by_deltas,
    "loads_logged": _loads_logged,
    "unpublished_load": _unpublished_load,
    "q4_countries_of_months": lambda i: _countries_of_months(i, 15),
    "q5_customers_of_months": _customers_of_months,
    # business questions
    "q1_monthly_net_sales": lambda i: business.monthly_net_sales(i.daily),
    "q2_category_revenue": lambda i: business.category_revenue(i.daily, i.products),
    "q3a_top_net_revenue": lambda i: business.top_net_revenue(i.daily, i.products),
    "q3b_top_return_rate": lambda i: business.top_return_rate(i.daily, i.products),
    "q4_countries": lambda i: business.countries(i.facts, 15),
    "q4_countries_top20": lambda i: business.countries(i.facts, 20),
    "q5_anonymous_vs_identified": lambda i: business.anonymous_vs_identified(i.facts, i.customers),
    "q5_with_flag": lambda i: business.anonymous_vs_identified(i.facts, i.customers, with_flag=True),
    "q6a_unique_codes": lambda i: business.unique_codes(i.products),
    "q6b_undescribed_products": lambda i: business.undescribed_products(i.products, i.facts),
    "q6c_blank_names": lambda i: business.blank_names(_nameless(i), i.facts),
    "q7_recommendation": lambda i: business.recommendation(i.daily, i.products),
    "q7_alerts": lambda i: business.alerts(i.daily, i.products),
    # derived metrics
    "yoy_net_growth": lambda i: metrics.yoy_net_growth(_months(i)),
    "mom_net_change": lambda i: metrics.mom_net_change(_months(i)),
    "season_share": lambda i: metrics.season_share(_months(i)),
    "return_rate_vs_average": lambda i: metrics.return_rate_vs_average(_months(i)),
    "anonymous_share": lambda i: metrics.anonymous_share(business.customer_type_totals(i.facts, i.customers)),
    "ticket_vs_home": lambda i: metrics.ticket_vs_home(business.country_totals(i.facts), HOME_COUNTRY),
    "top_n_net_total": lambda i: metrics.top_n_net_total(business.product_totals(i.daily, i.products)),
    "described_share": lambda i: metrics.described_share(i.products),
    "category_rate_ratio": lambda i: metrics.category_rate_ratio(business.category_totals(i.daily, i.products), "Table"),
    # integrity
    "fk_orphans": lambda i: quality.fk_orphans(i.tables),
    "pk_violations": lambda i: quality.pk_violations(i.tables),
    "domain_violations": lambda i: quality.domain_violations(i.facts),
    "not_null_violations": lambda i: quality.not_null_violations(i.tables),
    "length_violations": lambda i: quality.length_violations(i.tables),
    # profiling
    "profile_shape": lambda i: profiling.shape({"source1": i.raw1, "source2": i.raw2}),
    "profile_sample": lambda i: profiling.sample(i.text2),
    "zero_price_sample": lambda i: profiling.zero_price_sample(i.text1),
    "null_report": lambda i: profiling.null_report(i.text),
    "quantity_profile": lambda i: profiling.quantity_profile(i.text),
    "quantity_histogram": lambda i: profiling.quantity_histogram(i.text),
    "price_profile": lambda i: profiling.price_profile(i.text),
    "date_profile": lambda i: profiling.date_profile(i.text),
    "source_overlap": lambda i: profiling.source_overlap(i.text),
    "monthly_counts": lambda i: profiling.monthly_counts(i.text),
    "customer_profile": lambda i: profiling.customer_profile(i.text),
    "description_variants": lambda i: profiling.description_variants(i.text1),
    "most_varied_codes": lambda i: profiling.most_varied_codes(i.text1),
    "variant_summary": lambda i: profiling.variant_summary(i.text1),
    "variants_of_top_code": lambda i: profiling.variants_of_top_code(i.text1),
    "nonnumeric_codes": lambda i: profiling.nonnumeric_codes(i.text1),
    "duplicate_profile": lambda i: profiling.duplicate_profile(i.text),
    "overlapping_invoices": lambda i: profiling.overlapping_invoices(i.text),
    "country_profile": lambda i: profiling.country_profile(i.text1),
    # catalogue
    "build_catalog": lambda i: catalogue.build_catalogue(i.combined.drop("source_priority")),
    "build_catalog_source2": lambda i: catalogue.build_catalogue(i.source2),
    "catalog_file": _catalogue_file,
    "catalog_active": lambda i: i.catalogue.groupBy("is_active").agg(F.count("*").alias("products")),
    "catalog_category": lambda i: i.catalogue.groupBy("category").agg(F.count("*").alias("products")),
    "catalog_page": lambda i: catalogue.page_items(i.catalogue, **_PAGE),
    "catalog_page_deep": _deep_page,
    "catalog_page_summary": lambda i: catalogue.page_summary(i.catalogue, **_PAGE),
    "catalog_lookup": lambda i: catalogue.find_product(i.catalogue, " p17 "),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(query(inputs(spark, sf_dir)))

    return {name: bind(query) for name, query in _QUERIES.items()}
