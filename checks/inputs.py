"""Raw retail exports derived from the given tables, and the staged frames the queries share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import categories, cleaning, dimensions, facts, ingest, rejects
from tallyline.schemas import SOURCE1_COLUMNS, SOURCE2_COLUMNS
from tallyline.session import prepare, stage
from tallyline.sources import lines as sources
from tallyline.sources.keywords import KeywordMap
from tallyline.operators.catalogue import build_catalogue

FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
HOME_COUNTRY = "FRANCE"
KEYWORDS = KeywordMap({
    "Metal": ["ANVIL", "BOLT", "ROD"],
    "Mechanic": ["GEAR", "GIZMO", "WIDGET"],
    "Table": ["PLATE", "RING"],
})

# Every line of lineitem as an invoice line with realistic defects. Runs in Spark and DuckDB.
_RETAIL_COLUMNS = """
SELECT l.l_orderkey AS k, CAST(l.l_orderkey AS STRING) AS invoice,
 CASE WHEN (l.l_orderkey + l.l_linenumber) % 509 = 0 THEN NULL
      WHEN l.l_linenumber = 3 THEN ' p ' || CAST(l.l_partkey AS STRING) || ' '
      ELSE 'P' || CAST(l.l_partkey AS STRING) END AS code,
 CASE WHEN (l.l_orderkey + l.l_partkey) % 40 = 0 OR l.l_partkey % 97 = 0 THEN NULL
      WHEN l.l_linenumber = 2 THEN upper(p.p_name)
      WHEN l.l_linenumber = 5 THEN p.p_name || ' ' || p.p_type
      ELSE p.p_name END AS descr,
 CASE WHEN (l.l_orderkey * 7 + l.l_partkey) % 997 = 0 THEN 'n/a?'
      WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F'
        THEN '-' || CAST(CAST(l.l_quantity AS INT) AS STRING)
      ELSE CAST(CAST(l.l_quantity AS INT) AS STRING) END AS qty,
 o.o_orderdate AS d,
 CASE WHEN (l.l_orderkey + l.l_partkey) % 333 = 0 THEN '0'
      ELSE CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS STRING) END AS price,
 CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS STRING) || '.0' END AS cust,
 CASE WHEN n.n_nationkey = 24 THEN NULL ELSE n.n_name END AS country,
 (l.l_orderkey + l.l_partkey * 3) % 701 = 0 AS bad_date
"""
RETAIL_BASE = _RETAIL_COLUMNS + """FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
# The same inner joins in an order for large tables: lines move narrow to their part, then once, with what they take
# of it, to their order, which has its customer and nation already.
_PART_COLUMNS = "p.p_name, CASE WHEN l.l_linenumber = 5 THEN p.p_type END AS p_type, p.p_retailprice"
_RETAIL_BASE_AT_SIZE = _RETAIL_COLUMNS.replace("p.p_", "l.p_") + f"""FROM
(SELECT l.*, {_PART_COLUMNS} FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) l
JOIN (orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
ON l.l_orderkey = o.o_orderkey
"""
RAW_SOURCE1 = """
SELECT invoice AS `InvoiceNo`, code AS `StockCode`, descr AS `Description`, qty AS `Quantity`,
 CASE WHEN bad_date THEN 'not a date'
      ELSE CAST(month(d) AS STRING) || '/' || CAST(day(d) AS STRING) || '/' ||
           CAST(year(d) AS STRING) || ' 8:26' END AS `InvoiceDate`,
 price AS `UnitPrice`, cust AS `CustomerID`, country AS `Country`
FROM retail_base WHERE k % 3 <> 0
"""
RAW_SOURCE2 = """
SELECT invoice AS `Invoice`, code AS `StockCode`, descr AS `Description`, qty AS `Quantity`,
 CASE WHEN bad_date THEN 'not a date'
      ELSE CAST(CAST(d AS DATE) AS STRING) || ' 08:26:00' END AS `InvoiceDate`,
 price AS `Price`, cust AS `Customer ID`, country AS `Country`
FROM retail_base WHERE k % 3 <> 1
"""


class Inputs:
    """Frames over one data folder. Those that several queries read are staged once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    @cached_property
    def base(self) -> DataFrame:
        """The joined tables; both exports are filters on them."""
        tables = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet")
                  for t in ("lineitem", "orders", "customer", "part", "nation")}
        named = _RETAIL_BASE_AT_SIZE
        for table in tables:
            named = re.sub(rf"(FROM|JOIN|\() ?{table} ", rf"\1 {{{table}}} ", named)
        return stage(self.spark.sql(named, **tables), "retail-base")

    def _raw(self, text: str) -> DataFrame:
        return self.spark.sql(text.replace("retail_base", "{retail_base}"), retail_base=self.base)

    @cached_property
    def raw1(self) -> DataFrame:
        return self._raw(RAW_SOURCE1)

    @cached_property
    def raw2(self) -> DataFrame:
        return self._raw(RAW_SOURCE2)

    @property
    def text1(self) -> DataFrame:
        return sources.text_lines(self.raw1, SOURCE1_COLUMNS, "source1")

    @property
    def text2(self) -> DataFrame:
        return sources.text_lines(self.raw2, SOURCE2_COLUMNS, "source2")

    @property
    def text(self) -> DataFrame:
        return self.text1.unionByName(self.text2)

    @property
    def source1(self) -> DataFrame:
        return sources.source1_lines(self.raw1)

    @property
    def source2(self) -> DataFrame:
        return sources.source2_lines(self.raw2)

    @property
    def combined(self) -> DataFrame:
        return ingest.combine_sources(self.source1, self.source2)

    @property
    def unique(self) -> DataFrame:
        return ingest.unique_lines(self.combined)

    @cached_property
    def _staged_lines(self) -> tuple[DataFrame, DataFrame]:
        return cleaning.staged_lines(self.combined)

    @property
    def duplicates(self) -> DataFrame:
        return self._staged_lines[1]

    @property
    def checked(self) -> DataFrame:
        return self._staged_lines[0]

    @cached_property
    def fill_names(self) -> DataFrame:
        return stage(cleaning.fill_names(self.checked), "fill-names")

    @property
    def valid(self) -> DataFrame:
        return cleaning.accepted(self.checked)

    @cached_property
    def names(self) -> DataFrame:
        return stage(cleaning.canonical_names(self.checked, self.fill_names), "names")

    @cached_property
    def products(self) -> DataFrame:
        return stage(dimensions.products(categories.category_by_keyword(self.names, KEYWORDS)), "products")

    @cached_property
    def customers(self) -> DataFrame:
        return stage(dimensions.customers(self.valid), "customers")

    @property
    def calendar(self) -> DataFrame:
        return dimensions.calendar(self.spark, FIRST_DAY, LAST_DAY)

    @cached_property
    def facts(self) -> DataFrame:
        lines = facts.lines_of_facts(self.valid, ["invoice_no", "product_code_raw", "quantity_raw"])
        return facts.fact_transactions(lines)

    @cached_property
    def daily(self) -> DataFrame:
        return stage(facts.daily_revenue(self.facts), "daily")

    @cached_property
    def catalogue(self) -> DataFrame:
        return stage(build_catalogue(self.combined.drop("source_priority")), "catalogue")

    @property
    def rejected(self) -> DataFrame:
        return rejects.rejected_rows(self.checked, self.fill_names, self.duplicates)

    @property
    def reject_log(self) -> DataFrame:
        return rejects.reject_log(self.rejected)

    @property
    def run_row(self) -> DataFrame:
        counts = ingest.dedup_counts(self.combined)
        loaded = self.facts.groupBy().count().scalar()
        rejected = self.rejected.groupBy().count().scalar()
        return rejects.run_log_row(self.spark, "run-1", "2001-12-31",
                                   counts.select("lines_before").scalar(), loaded, rejected)

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        return _Tables({
            "dim_products": lambda: self.products, "dim_customers": lambda: self.customers, "dim_date": lambda: self.calendar,
            "fact_transactions": lambda: self.facts, "fact_daily_revenue": lambda: self.daily,
            "log_rejected_records": lambda: self.reject_log, "log_pipeline_runs": lambda: self.run_row,
        })


class _Tables(Mapping):
    """Tables by name, each made when it is asked for: a check of some tables does not build the others."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


_cache: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cache:
        _cache[key] = Inputs(spark, sf_dir)
    return _cache[key]
