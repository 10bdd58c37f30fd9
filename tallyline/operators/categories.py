"""Product categories from a catalogue or from keywords in the product name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import contains_any
from tallyline.schemas import DEFAULT_CATEGORY
from tallyline.sources.keywords import KeywordMap


def keyword_category(name: Column, keywords: KeywordMap) -> Column:
    """First category, in map order, one of whose words is a substring of the upper-cased name."""
    upper = F.upper(name)
    matches = [F.when(contains_any(upper, words), category)
               for category, words in keywords.categories.items()]
    return F.coalesce(*matches, F.lit(keywords.default))


def category_by_keyword(products: DataFrame, keywords: KeywordMap) -> DataFrame:
    return products.withColumn("category", keyword_category(F.col("canonical_name"), keywords))


def category_by_catalogue(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Category of the same code in the catalogue. One row per product on both sides."""
    known = catalogue.select(F.col("code").alias("product_code"), "category")
    return products.join(known, "product_code", "left").withColumn(
        "category", F.coalesce("category", F.lit(DEFAULT_CATEGORY))
    )


def assign_category(products: DataFrame, keywords: KeywordMap,
                    catalogue: DataFrame | None = None) -> DataFrame:
    """Catalogue for all products if it has any entry, else keywords for all of them."""
    if catalogue is not None and not catalogue.isEmpty():
        return category_by_catalogue(products, catalogue)
    return category_by_keyword(products, keywords)
