"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldbook.functions.nulls import as_col


def round_even(value: str | Column, digits: int = 0) -> Column:
    """Round half to even (Spark's ``round`` rounds half up)."""
    return F.bround(as_col(value), digits)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """Quotient as double; NULL where the divisor is 0."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def text_to_int(value: str | Column) -> Column:
    """Text to integer, truncating fractions; NULL if it is not a number."""
    return F.trim(as_col(value)).try_cast("double").try_cast("int")


def text_to_double(value: str | Column) -> Column:
    return F.trim(as_col(value)).try_cast("double")


def percent_text(share: str | Column, digits: int = 2) -> Column:
    """A share as percentage text for a report."""
    return F.concat(F.format_number(as_col(share) * 100, digits), F.lit("%"))


def grouped_text(value: str | Column, digits: int = 0) -> Column:
    """A number with thousands marks for a report."""
    return F.format_number(as_col(value), digits)


def minutes(hours: str | Column) -> Column:
    return round_even(as_col(hours) * 60)


def percent_change(change: str | Column, base: str | Column) -> Column:
    return ratio(change, base) * 100


def exceeds_percent(change: str | Column, base: str | Column, threshold: float) -> Column:
    """|change / base| above a percentage. A change on a zero base is infinite, hence TRUE;
    no change on a zero base is undefined, hence NULL."""
    c, b = as_col(change), as_col(base)
    return F.when((b == 0) & (c != 0), F.lit(True)).otherwise(
        F.abs(percent_change(c, b)) > F.lit(float(threshold))
    )
