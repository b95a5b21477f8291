"""Date parts of the feed's numeric dates, and the period prefixes that select its files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def reference_period(year: str, month: str, day: str = "", sep: str = "") -> str:
    """``2019, 01, 15`` → ``20190115``; without a day the period is the month."""
    return sep.join(part for part in (year, month, day) if part) if day else sep.join((year, month))


def in_period(stamp: Column, period: str) -> Column:
    """Whether a stamp, or a name or date that begins with one, lies in a period: its first digits, however many."""
    return stamp.startswith(period)


def date_parts(date: Column) -> dict[str, Column]:
    """Year, month and day, as text, of a date that begins with yyyyMMdd (text or number)."""
    text = date.cast("string")
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 5, 2),
        "day": F.substring(text, 7, 2),
    }


def item_date_parts(date: Column, calendar_months: bool = False) -> dict[str, Column]:
    """Date parts as the item marts label them.

    Their month label runs to the end of the date ("0115" on 15 January), which leaves the groups as they are;
    ``calendar_months`` gives the two-digit month instead.
    """
    day = F.substring(date.cast("string"), 1, 8)
    return {
        "date": day,
        "year": F.substring(day, 1, 4),
        "month": F.substring(day, 5, 2 if calendar_months else 6),
        "day": F.substring(day, 7, 8),
    }


def feed_day(date: Column) -> Column:
    """A yyyyMMdd date, text or number, as a DATE; null when it is none."""
    return F.try_to_date(date.cast("string"), "yyyyMMdd")
