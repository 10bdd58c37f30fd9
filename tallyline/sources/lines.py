"""Reading the two raw exports into one canonical line table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import dates
from tallyline.functions.text import missing_to_null
from tallyline.schemas import CANONICAL_COLUMNS, SOURCE1_COLUMNS, SOURCE2_COLUMNS


def read_csv_text(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8",
                  multi_line: bool = False) -> DataFrame:
    """A CSV export with every column as text, plus ``line_order``, the place of the line.

    Each file's header has to have these columns in this order; a file with another one fails the
    read, so that no value gets into a wrong column. ``multi_line`` is needed only for quoted line
    breaks; it stops Spark from splitting files.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    table = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("encoding", encoding).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return table.withColumn("line_order", place)


def text_lines(raw: DataFrame, columns: dict[str, str], source: str) -> DataFrame:
    """Canonical column names and missing cells as null; every value is still the file's text."""
    cells = {name: missing_to_null(F.col(f"`{header}`")) for header, name in columns.items()}
    cells["source"] = F.lit(source)
    extra = [F.col("line_order")] if "line_order" in raw.columns else []
    return raw.select(*[cells[name].alias(name) for name in CANONICAL_COLUMNS], *extra)


def to_canonical(raw: DataFrame, columns: dict[str, str], date_format: str, source: str) -> DataFrame:
    """Rename one export to the canonical columns, render its dates as ISO text, tag the source."""
    stamp = dates.source_timestamp(F.col("invoice_date"), date_format)
    return text_lines(raw, columns, source).withColumn("invoice_date", dates.iso_text(stamp))


def source1_lines(raw: DataFrame) -> DataFrame:
    return to_canonical(raw, SOURCE1_COLUMNS, dates.SOURCE1_FORMAT, "source1")


def source2_lines(raw: DataFrame) -> DataFrame:
    return to_canonical(raw, SOURCE2_COLUMNS, dates.SOURCE2_FORMAT, "source2")


def read_source1(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return source1_lines(read_csv_text(spark, path, list(SOURCE1_COLUMNS), "ISO-8859-1", multi_line))


def read_source2(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return source2_lines(read_csv_text(spark, path, list(SOURCE2_COLUMNS), "UTF-8", multi_line))


def yearly_union(years: list[DataFrame]) -> DataFrame:
    """One table from a workbook's yearly sheets; ``sheet`` keeps the order of the sheets."""
    sheets = [sheet.withColumn("sheet", F.lit(number)) for number, sheet in enumerate(years)]
    return reduce(DataFrame.unionByName, sheets)
