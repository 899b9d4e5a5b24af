"""Calendar expressions. A text without a year is no date: nothing is filled in from today."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairnbook.functions.strings import strip

_MONTH_INDEX = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"
MONTH_FIRST = rf"(?i)^{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})$"
DAY_FIRST = rf"(?i)^(\d{{1,2}})\s+{_MONTH},?\s+(\d{{4}})$"
YEAR_FIRST = r"^(\d{4})/(\d{2})/(\d{2})$"
NUMERIC = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4}|\d{2})$"
# Spellings rewritten to year-month-day, one after the other.
REWRITES = (
    (r"(?s)^(\d{4}-\d{2}-\d{2}).*$", "$1"),
    (YEAR_FIRST, "$1-$2-$3"),
    (MONTH_FIRST, "$3-$1-$2"),
    (DAY_FIRST, "$3-$2-$1"),
    (r"^(\d{1,2}[/-]\d{1,2}[/-])([0-6]\d)$", "$120$2"),
    (r"^(\d{1,2}[/-]\d{1,2}[/-])([7-9]\d)$", "$119$2"),
    (r"^(1[3-9]|[2-9]\d)[/-](\d{1,2})[/-](\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3-$1-$2"),
)


def month_number(name: Column) -> Column:
    """1..12 for an English month name or its first three letters."""
    at = F.instr(F.lit(_MONTH_INDEX), F.lower(F.substring(name, 1, 3)))
    return ((at + 2) / 3).cast("int")


def checked_date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws(
        "-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")
    )
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_date(c: Column) -> Column:
    """DATE for the accepted spellings, else null.

    A leading yyyy-MM-dd decides alone, so a zone offset never moves the local day. The
    spellings are rewritten in a chain: the text occurs once in the expression, however deep it is."""
    s = strip(c)
    for pattern, form in REWRITES:
        s = F.regexp_replace(s, pattern, form)
    return F.coalesce(F.try_to_date(s, "yyyy-M-d"), F.try_to_date(s, "yyyy-MMM-d"))


def iso_date(c: Column) -> Column:
    return F.date_format(parse_date(c), "yyyy-MM-dd")


def run_stamp(ts: Column, zone: str) -> Column:
    """File-name time stamp yyyyMMdd_HHmmss of a UTC instant, shown in ``zone``."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyyMMdd_HHmmss")


def zoned_iso(ts: Column, zone: str) -> Column:
    """ISO text with seconds and the zone's offset at that instant."""
    local = F.from_utc_timestamp(ts, zone)
    minutes = ((F.unix_timestamp(local) - F.unix_timestamp(ts)) / 60).cast("int")
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    hours = F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0")
    rest = F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), sign, hours, F.lit(":"), rest)
