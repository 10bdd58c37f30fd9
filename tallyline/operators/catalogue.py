"""Product catalogue built from the raw lines of one or both exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions.ranking import number_rows
from tallyline.functions.text import strip
from tallyline.operators.categories import keyword_category
from tallyline.schemas import CATALOGUE, SUPPLIER_COUNTRY
from tallyline.session import stage
from tallyline.sources.keywords import CATALOGUE_KEYWORDS, KeywordMap

ACTIVE_DAYS = 180
MAX_PAGE_SIZE = 200


def build_catalogue(lines: DataFrame, keywords: KeywordMap = CATALOGUE_KEYWORDS,
                    active_days: int = ACTIVE_DAYS) -> DataFrame:
    """One record per code from canonical lines; source 1 comes first when names tie.

    Two partial aggregations, (code, name) then code. The first is staged: it also gives the
    latest date overall.
    """
    if "line_order" in lines.columns:
        place = [F.col("line_order")]
    else:
        place = [F.col(c) for c in ("invoice_no", "quantity", "invoice_date", "unit_price",
                                    "customer_id", "country")]
    clean = lines.select(
        F.upper(strip(F.col("product_code"))).alias("code"),
        strip(F.col("description")).alias("name"),
        dates.general_timestamp(F.col("invoice_date")).alias("ts"),
        F.struct(F.col("source"), *place).alias("place"),
    ).where("code IS NOT NULL AND code NOT IN ('', 'NAN')")
    named = stage(clean.groupBy("code", "name").agg(
        F.count("*").alias("n"), F.min("place").alias("first"), F.max("ts").alias("last")), "code-names")
    best = F.min_by("name", F.struct(F.col("name").isNull(), -F.col("n"), F.col("first")))
    codes = named.groupBy("code").agg(best.alias("name"), F.max("last").alias("last"))
    cutoff = named.agg((F.max("last") - F.make_dt_interval(F.lit(active_days))).alias("cutoff")).scalar()
    records = codes.where("name IS NOT NULL").select(
        "code", "name",
        keyword_category(F.col("name"), keywords).alias("category"),
        F.lit(SUPPLIER_COUNTRY).alias("supplier_country"),
        F.coalesce(F.col("last") >= cutoff, F.lit(False)).alias("is_active"),
    )
    return records.select(CATALOGUE.fieldNames())


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """One JSON object per line; text is written as it is, not as escapes."""
    catalogue.write.mode("errorifexists").json(path)


def read_catalogue(spark, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).json(path)


def _selected(catalogue: DataFrame, category: str | None, active_only: bool) -> DataFrame:
    if category:
        catalogue = catalogue.where(F.lower("category") == category.lower())
    return catalogue.where("is_active") if active_only else catalogue


def _check_page(page: int, size: int) -> None:
    if page < 1 or not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"page must be >= 1 and size within 1..{MAX_PAGE_SIZE}")


def page_summary(catalogue: DataFrame, page: int = 1, size: int = 50, category: str | None = None,
                 active_only: bool = False) -> DataFrame:
    """Total, page, size and number of pages (at least 1)."""
    _check_page(page, size)
    total = _selected(catalogue, category, active_only).agg(F.count("*").alias("total"))
    pages = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("total") / size))
    return total.select("total", F.lit(page).cast("bigint").alias("page"),
                        F.lit(size).cast("bigint").alias("size"), pages.alias("pages"))


def page_items(catalogue: DataFrame, page: int = 1, size: int = 50, category: str | None = None,
               active_only: bool = False) -> DataFrame:
    """The records of one page in code order.

    Rows are numbered by a distributed sort and filtered, at any depth: a top-k of a late page would
    hold all pages before it. Only the page itself is sorted at the end.
    """
    _check_page(page, size)
    numbered = number_rows(_selected(catalogue, category, active_only), [F.col("code")])
    start = (page - 1) * size
    return numbered.where(F.col("position").between(start, start + size - 1)).drop("position").orderBy("code")


def find_product(catalogue: DataFrame, code: str) -> DataFrame:
    return catalogue.where(F.col("code") == code.upper().strip())
