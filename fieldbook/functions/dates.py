"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldbook.functions.nulls import as_col


def parse_mdy_hms(value: str | Column) -> Column:
    """Month/day/year time, 12-hour with AM/PM or 24-hour; NULL if it does not fit.

    Parsed as UTC and counted from the epoch, so that no session time zone shifts local times.
    The ending decides the pattern first: a failed parse costs far more than a text test.
    """
    c = as_col(value)
    text = F.concat(c, F.lit(" Z"))
    twelve = F.try_to_timestamp(text, F.lit("M/d/yyyy h:mm:ss a X"))
    day = F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm:ss X"))
    moment = F.when(F.lower(F.right(c, F.lit(1))) == "m", twelve).otherwise(day)
    return F.timestamp_add("SECOND", F.unix_seconds(moment), midnight("1970-01-01"))


def parse_year_month(year: str | Column, month: str | Column) -> Column:
    """First day of a month given as a year and an English month abbreviation."""
    text = F.concat_ws(" ", as_col(year).cast("string"), as_col(month))
    return F.try_to_date(text, "yyyy MMM")


def year_week_label(day: str | Column) -> Column:
    """Calendar year plus ISO week. Both ends of a year can carry one label
    (2023-01-01 and 2023-12-31 are ``2023-52``); ``week_start`` has no such clash."""
    c = as_col(day)
    return F.concat(
        F.lpad(F.year(c).cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad(F.weekofyear(c).cast("string"), 2, "0"),
    )


def week_start(day: str | Column) -> Column:
    return F.trunc(as_col(day), "week")


def midnight(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def between_midnights(value: str | Column, first: str, last: str) -> Column:
    """Inclusive range whose ends are midnights: later hours of the last day fall out."""
    return as_col(value).between(midnight(first), midnight(last))
