"""Number rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import strip

# A cast to DOUBLE alone also takes Java suffixes ("12d"), "inf" and "nan".
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """Decimal text to DOUBLE; anything that is not a finite number is null."""
    return _finite(_parsed(strip(text)))


def _parsed(stripped: Column) -> Column:
    return F.when(stripped.rlike(_NUMBER), stripped.try_cast("double"))


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def with_numbers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``to_number`` of text columns as ``{new name: text column}``.

    Each step is its own projection: the expressions use their operand twice, and a projection
    makes Spark compute it once per row.
    """
    stripped = df.withColumns({new: strip(F.col(old)) for new, old in columns.items()})
    parsed = stripped.withColumns({new: _parsed(F.col(new)) for new in columns})
    return parsed.withColumns({new: _finite(F.col(new)) for new in columns})


def number_text(value: Column) -> Column:
    """Whole numbers without a fraction, others as they are."""
    whole = value.try_cast("bigint")
    return F.when(whole == value, whole.cast("string")).otherwise(value.cast("string"))


def _exact(value: Column) -> Column:
    # 24 digits leave 14 decimals for the quotient; wider sums would be rounded to 6.
    return value.try_cast("decimal(24,4)")


def quotient(part: Column, total: Column) -> Column:
    """``part / total``; null when the total is 0.

    Exact to 14 decimals while both sides have at most 24 digits. Larger sums are divided as DOUBLE, which
    keeps 15 digits of the quotient; a quotient that 38 digits cannot hold is null.
    """
    exact = F.try_divide(_exact(part), _exact(total))
    rough = F.try_divide(part.cast("double"), total.cast("double")).try_cast("decimal(38,14)")
    fits = _exact(part).isNotNull() & _exact(total).isNotNull()
    return F.when(fits, exact.cast("decimal(38,14)")).otherwise(rough)


def hundredfold(part: Column, total: Column) -> Column:
    """``100 * part / total``, not rounded."""
    return F.try_multiply(quotient(part, total), F.lit(100))


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return rounded(hundredfold(part, total), digits)


def ratio(part: Column, total: Column, digits: int = 2) -> Column:
    return rounded(quotient(part, total), digits)


def rounded(value: Column, digits: int = 2) -> Column:
    """Rounded half away from zero."""
    return F.round(value, digits).cast(f"decimal(38,{digits})")
