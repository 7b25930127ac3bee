"""Date expressions (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.text import strip
from opinara.schemas import JOINED_SOURCE, NULL_KEY


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def spoken_date(c: Column) -> Column:
    """"Reviewed 6 February 2022", with or without the first word, to ISO; else null."""
    bare = strip(F.regexp_replace(c, r"(?i)^\s*reviewed\s+", ""))
    bare = F.regexp_replace(bare, r"\s+", " ")
    shaped = bare.rlike(r"^\d{1,2} [A-Za-z]+ \d{4}$")
    return iso(F.try_to_timestamp(F.when(shaped, bare), F.lit("d MMMM yyyy")))


# English month names, as a short form and what may follow it.
_MONTH = (
    r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    r"(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\b\.?"
)
# Days in digits, rewritten as year-month-day. Month first; day first where that is no month.
_DIGITS = [
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3"),
    (r"^(1[3-9]|2\d|3[01])[/.-](\d{1,2})[/.-](\d{4})", "$3-$2-$1"),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", "$3-$1-$2"),
]


def any_timestamp(c: Column) -> Column:
    """Timestamp of a machine-written date in any of the known spellings, else null.

    ISO days and times; compact, slashed, dotted or dashed days in digits; days with an
    English month name, before or after the day. A time of day may follow.
    """
    bare = F.trim(c)
    iso_like = F.when(bare.rlike(r"^\d{4}(-|$)"), bare.try_cast("timestamp"))
    digits = bare
    for shape, to in _DIGITS:
        digits = F.regexp_replace(digits, shape, to)
    digits = F.when(bare.rlike(r"^(\d{8}(?!\d)|\d{4}[/.]|\d{1,2}[/.-]\d)"), digits.try_cast("timestamp"))
    # One spelling for the rest: short month, day, year.
    named = F.regexp_replace(F.regexp_replace(bare, r"[,\s]+", " "), _MONTH, "$1")
    named = F.initcap(F.regexp_replace(named, r"^(\d{1,2}) ([A-Za-z]{3}) ", "$2 $1 "))
    named = F.when(bare.rlike("[A-Za-z]{3}"), F.try_to_timestamp(named, F.lit("MMM d yyyy[ H:mm[:ss]]")))
    return F.coalesce(iso_like, digits, named)


def event_date(c: Column) -> Column:
    return iso(any_timestamp(c))


def silver_timestamp(c: Column) -> Column:
    """Timestamp of a Silver date, machine-written first, spoken second."""
    return F.coalesce(any_timestamp(c), spoken_date(c).try_cast("timestamp"))


def partition_key(iso_date: Column) -> Column:
    return F.coalesce(F.when(iso_date != "", iso_date), F.lit(NULL_KEY))


def review_date_key(c: Column) -> Column:
    return partition_key(iso(silver_timestamp(c)))


def gold_review_date(raw: Column, source: Column, key: Column) -> Column:
    """Event date of a Gold row inside partition ``key``; undated rows have none."""
    return (
        F.when(key == NULL_KEY, F.lit(None).cast("string"))
        .when((source == JOINED_SOURCE) & raw.isNotNull(), F.coalesce(event_date(raw), key))
        .when((F.length(raw) >= 10) & (F.substring(raw, 5, 1) == "-"), F.substring(raw, 1, 10))
        .otherwise(key)
    )


def years_before(c: Column, years: int) -> Column:
    return c - F.make_ym_interval(F.lit(years), F.lit(0))


def period(c: Column, freq: str) -> Column:
    """First instant of the day (``D``) or Monday-based week (``W``)."""
    return F.date_trunc({"D": "day", "W": "week"}[freq], c)
