"""Column expressions that turn raw extract text into typed values.

All of them give NULL for text that does not fit, whatever ``spark.sql.ansi.enabled`` says, and
all stay inside generated code. Timestamps are wall-clock values without a zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that mean "no value" (exact, case-sensitive, untrimmed).
PLACEHOLDERS = [".", "-", "Undefined", "Not found"]

# Month names as the complaint extract spells them (case-sensitive).
MONTH_NUMBERS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
    "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}

# Outage spellings of billing centres -> the billing system's spelling.
CENTRE_SPELLINGS = {"Liaquatabad": "Liaqatabad", "FB Area": "F.B. Area"}

# The two timestamp layouts of the outage extract.
SLASH_LAYOUT = (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm")
DASH_LAYOUT = (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss")


def _timestamp(text: Column, layout: str) -> Column:
    return F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")


def finite(text: Column) -> Column:
    """Text as a double; ``NaN`` and ``Infinity``, which casts accept, are no values here."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _recent_century(parsed: Column) -> Column:
    """Two-digit years are read as 20xx; those over 20 years ahead of today belong to 19xx."""
    ahead = parsed > F.localtimestamp() + F.make_ym_interval(F.lit(20))
    return F.when(ahead, parsed - F.make_ym_interval(F.lit(100))).otherwise(parsed)


def null_placeholder(text: Column, placeholders: list[str] = PLACEHOLDERS) -> Column:
    return F.when(~text.isin(placeholders), text)


def month_abbr_date(text: Column) -> Column:
    """``5-Mar-23`` or ``05-Mar-23``; the month's case is ignored."""
    return _recent_century(_timestamp(text, "d-MMM-yy"))


def month_abbr_timestamp(text: Column) -> Column:
    """``5-Mar-23 14:05:09``."""
    return _recent_century(_timestamp(text, "d-MMM-yy HH:mm:ss"))


def day_month_year(text: Column) -> Column:
    """``5/3/2023`` and ``05/03/23``; each layout rejects the other's year width."""
    return F.coalesce(
        _timestamp(text, "d/M/yyyy"), _recent_century(_timestamp(text, "d/M/yy"))
    )


def outage_timestamp(text: Column) -> Column:
    """Either outage layout, chosen by shape; anything else is NULL."""
    return F.when(text.rlike(SLASH_LAYOUT[0]), _timestamp(text, SLASH_LAYOUT[1])).when(
        text.rlike(DASH_LAYOUT[0]), _timestamp(text, DASH_LAYOUT[1])
    )


def clock_minutes(text: Column) -> Column:
    """``h:m:s`` as minutes; text without exactly three whole numbers is NULL."""
    parts = F.split(text, ":")
    hour, minute, second = (F.get(parts, i).try_cast("int") for i in range(3))
    return F.when(
        F.size(parts) == 3, hour.cast("double") * 60 + minute + second / F.lit(60.0)
    )


def hours_as_minutes(hours: Column) -> Column:
    return finite(hours) * 60


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    return F.try_element_at(table, name)


def number_with_commas(text: Column) -> Column:
    return finite(F.regexp_replace(text, ",", ""))


def digits_or_null(text: Column) -> Column:
    """Predicate: only digits, or no value at all."""
    return text.isNull() | text.rlike("^[0-9]+$")


def blank_as_zero(text: Column) -> Column:
    return F.when(text.isNull() | text.rlike(r"^\s*$"), 0).otherwise(text.try_cast("int"))


def yes_flag(text: Column) -> Column:
    return F.when(text == "YES", 1).otherwise(0)


def billing_month_date(yyyymm: Column) -> Column:
    """First day of a ``YYYYMM`` month; a month 13 is NULL."""
    return F.try_to_date(F.concat(F.lpad(yyyymm, 6, "0"), F.lit("01")), "yyyyMMdd")


def billing_year(yyyymm: Column) -> Column:
    return F.substring(yyyymm, 1, 4).try_cast("int")


def billing_month(yyyymm: Column) -> Column:
    return F.substring(yyyymm, 5, 2).try_cast("int")


def month_in_path(path: Column) -> Column:
    """Six digits after ``_`` in the file name or the folder holding it; NULL where absent."""
    found = F.regexp_extract(path, r"_(\d{6})(?!\d)(?:[^/]*/)?[^/]*$", 1)
    return F.when(found != "", found)


def respell(name: Column, spellings: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), name)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)
