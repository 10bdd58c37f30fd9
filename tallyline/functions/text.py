"""Text rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import BLANK_TOKENS, NA_TOKENS

# Every code point that counts as white space for trimming, not only the blank.
WHITESPACE = "".join(
    chr(point)
    for first, last in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                        (0x3000, 0x3000)]
    for point in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Texts that begin and end with a printable ASCII character, nearly all, are not searched for white space."""
    first, last = F.ascii(text), F.ascii(F.substring(text, -1, 1))
    return F.when(first.between(33, 126) & last.between(33, 126), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def remove_whitespace(text: Column) -> Column:
    """Only texts with something else than printable ASCII characters are rewritten."""
    return F.when(text.rlike("^[!-~]*+\\z"), text).otherwise(F.translate(text, WHITESPACE, ""))


def missing_to_null(text: Column) -> Column:
    """Cell texts such as ``NA`` or the empty string become null."""
    return F.when(~text.isin(NA_TOKENS), text)


def blank_to_null(text: Column) -> Column:
    """Strip, and turn blank texts into null."""
    return _not_blank(strip(text))


def _not_blank(stripped: Column) -> Column:
    return F.when(~stripped.isin(BLANK_TOKENS), stripped)


def with_blank_to_null(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``blank_to_null`` of text columns as ``{new name: text column}``, stripping each once."""
    stripped = df.withColumns({new: strip(F.col(old)) for new, old in columns.items()})
    return stripped.withColumns({new: _not_blank(F.col(new)) for new in columns})


def product_code(text: Column) -> Column:
    """Upper case without any white space."""
    return remove_whitespace(F.upper(text))


def contains_any(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit
