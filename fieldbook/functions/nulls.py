"""Expressions whose missing-value rules differ from plain SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def not_in(value: str | Column, members: Iterable) -> Column:
    """Negated membership that keeps rows whose value is NULL."""
    return ~F.coalesce(as_col(value).isin(list(members)), F.lit(False))


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice that stays NULL where the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def blank_to_null(value: str | Column, marker: str) -> Column:
    return F.nullif(as_col(value), F.lit(marker))


def _whole(value: Column, aggregate: Column) -> Column:
    return F.when(F.count(value) == F.count(F.lit(1)), aggregate)


def strict_sum(value: str | Column) -> Column:
    """Sum that is NULL as soon as one input is NULL; 0 over no rows."""
    return _whole(as_col(value), sum_or_zero(value))


def strict_max(value: str | Column) -> Column:
    return _whole(as_col(value), F.max(as_col(value)))


def strict_min(value: str | Column) -> Column:
    return _whole(as_col(value), F.min(as_col(value)))


def strict_mean(value: str | Column) -> Column:
    return _whole(as_col(value), F.avg(as_col(value)))


def sum_or_zero(value: str | Column) -> Column:
    """Sum over the present values; 0 if there are none."""
    return F.coalesce(F.sum(as_col(value)), F.lit(0))


def n_distinct(value: str | Column) -> Column:
    """Distinct count in which NULL is one more value."""
    c = as_col(value)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
