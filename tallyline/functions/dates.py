"""Date parsing as column expressions. Wall clocks are labelled UTC and never shifted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed layouts: the exact one of each export, then those of the general parse in order.
SOURCE1_FORMAT = "M/d/yyyy H:mm"
SOURCE2_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FIRST = ["yyyy-MM-dd[ HH:mm[:ss]]", "yyyy-MM-dd'T'HH:mm[:ss]", "M/d/yyyy[ H:mm[:ss]]"]
DAY_FIRST = ["d/M/yyyy[ H:mm[:ss]]"]
# Less frequent layouts, tried last: year first, fractions and offsets, dashes, month names.
OTHERS = [
    "yyyy/M/d[ H:mm[:ss]]", "yyyy-M-d[ H:mm[:ss]]", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm[:ss][ ]XXX", "yyyy-MM-dd'T'HH:mm[:ss]XXX", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "M-d-yyyy[ H:mm[:ss]]", "d-M-yyyy[ H:mm[:ss]]", "d MMM yyyy[ H:mm[:ss]]", "d-MMM-yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]", "MMMM d, yyyy[ H:mm[:ss]]", "M/d/yyyy h:mm[:ss] a",
]


# Texts in the layout of the second export. A cast reads such a text as that layout and the first of MONTH_FIRST do,
# and faster; for a year 0 or a day that does not exist the layouts decide.
_ISO = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def first_match(text: Column, formats: list[str]) -> Column:
    """First layout that parses; later layouts are only tried where the earlier ones fail."""
    layouts = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    if formats[0] in (SOURCE2_FORMAT, MONTH_FIRST[0]):
        layouts.insert(0, F.when(text.rlike(_ISO), text.try_cast("timestamp")))
    return F.coalesce(*layouts)


def source_timestamp(text: Column, exact: str) -> Column:
    """The export's own layout, then the general parse."""
    return first_match(text, [exact, *MONTH_FIRST, *DAY_FIRST, *OTHERS])


def general_timestamp(text: Column) -> Column:
    """ISO, then month first, then day first, then the other layouts. Times with an offset are put to UTC."""
    return first_match(text, [*MONTH_FIRST, *DAY_FIRST, *OTHERS])


def iso_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def iso_text_utc(stamp: Column) -> Column:
    return F.concat(iso_text(stamp), F.lit("+00:00"))


def month_of(date: Column) -> Column:
    return F.trunc(date, "MM")
