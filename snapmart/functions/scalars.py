"""Column expressions built only from Spark's built-in functions.

All of them stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the duration pattern of the listings (ISO-8601 time part only,
# unanchored; groups 2, 4 and 6 hold hours, minutes and seconds).
DURATION_PATTERN = r"PT((\d+)H)?((\d+)M)?((\d+)S)?"
_DURATION_GROUP = {"hour": 2, "minutes": 4, "seconds": 6}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_part(c, part: str) -> Column:
    """One part of an ISO-8601 duration as int; a missing part, a day-only
    duration, an empty string or null all give 0."""
    raw = F.regexp_extract(_c(c), DURATION_PATTERN, _DURATION_GROUP[part])
    return F.coalesce(F.nullif(raw, F.lit("")).try_cast("int"), F.lit(0))


def iso_duration(c, prefix: str = "content_duration") -> list[Column]:
    return [duration_part(c, p).alias(f"{prefix}_{p}") for p in ("hour", "minutes", "seconds")]


def to_date_safe(c) -> Column:
    """String (date or ISO timestamp text, cut as written) or timestamp to
    date; text that is no date gives null instead of failing the job."""
    return F.try_to_date(_c(c))


def datekey(c) -> Column:
    """Date to its ``yyyyMMdd`` key."""
    return F.date_format(_c(c), "yyyyMMdd")


def safe_ratio(num, den) -> Column:
    """num / den as double, null where den is 0 or null."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0))


def quarter_label(q) -> Column:
    """Quarter number (1-4) to its label, ``Q1`` ... ``Q4``."""
    return F.concat(F.lit("Q"), _c(q).cast("string"))


def month_name(d) -> Column:
    """English month name of a date."""
    return F.date_format(_c(d), "MMMM")


def month_name_of(m) -> Column:
    """English month name of a month number (1-12)."""
    return month_name(F.make_date(F.lit(2000), _c(m), F.lit(1)))


def split_list(c, sep: str = ",") -> Column:
    """Comma list to array: null stays null, '' gives ['']."""
    return F.split(_c(c), sep)


def url_tail(c) -> Column:
    """Last '/'-separated segment of a URL (empty when it ends in '/')."""
    return F.element_at(F.split(_c(c), "/"), -1)


def topic_names(arr) -> Column:
    """Topic URL array to a comma list of their last path segments;
    a missing array gives ''."""
    arr = F.coalesce(_c(arr), F.array().cast("array<string>"))
    return F.array_join(F.transform(arr, url_tail), ",")


def null_or_text_null(c) -> Column:
    """True when the value is null or its text contains ``NULL``."""
    c = _c(c)
    return c.isNull() | c.cast("string").contains("NULL")
