"""Dates and display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(col: Column) -> Column:
    """The day of an ISO date, or of an ISO date with a time of day; null for any other text, which never fails the job.

    A date or timestamp cast to text reads back as its day.
    """
    timed = F.when(col.rlike(r"^\s*\d{4}-\d{2}-\d{2}[ T]\d"), F.try_to_timestamp(col).cast("date"))
    return F.coalesce(F.try_to_date(col, "yyyy-MM-dd"), timed)


def iso_date(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def month_name(col: Column) -> Column:
    return F.date_format(col, "MMMM")


def day_name(col: Column) -> Column:
    return F.date_format(col, "EEEE")


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def insensitive(col: Column) -> Column:
    """Compare text without case, accents and trailing blanks, as the SQL side of a web shop does.

    Text is compared byte by byte unless a column is wrapped in this.
    """
    return F.collate(col, "UNICODE_CI_AI_RTRIM")


def padded_id(prefix: str, col: Column, width: int) -> Column:
    """A key such as ORD0000042; a number wider than the field keeps all its digits."""
    digits = col.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def thousands(col: Column, places: int = 0) -> Column:
    return F.format_number(col, places)


def percent_text(col: Column, places: int = 1) -> Column:
    """A fraction shown as a percentage, such as 66.1%."""
    return F.concat(F.format_string(f"%.{places}f", col * 100), F.lit("%"))
