"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.columns import col


def ymd(c: Column | str) -> Column:
    """Date of a ``yyyyMMdd`` text or number; anything else -> null."""
    return F.try_to_date(col(c).cast("string"), "yyyyMMdd")


def rfc822(c: Column | str) -> Column:
    """Instant of ``Mon, 01 Jan 2024 09:00:00 +0900``; anything else -> null.

    The weekday is cut off: it carries no information and its pattern letter is
    not accepted when parsing.
    """
    t = F.regexp_replace(F.trim(col(c)), r"^[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss Z"))


def weekday_name(c: Column | str) -> Column:
    return F.date_format(col(c).cast("date"), "EEEE")


def is_weekend(c: Column | str) -> Column:
    return F.weekday(col(c).cast("date")) >= 5


def year_of(c: Column | str) -> Column:
    """Year in the first four characters of a date text; no number -> null."""
    return F.substring(col(c).cast("string"), 1, 4).try_cast("int")
