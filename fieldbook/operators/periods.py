"""Comparisons between consecutive periods.

The windows here run over aggregated tables with one row per period (or per key and
period), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fieldbook.functions.numbers import ratio
from fieldbook.operators.joins import equi_join


def overlap_with_previous(top: DataFrame, period: str, item: str, size: int) -> DataFrame:
    """Items kept from, and new since, the previous period that is present.

    A join instead of collected sets: a list with many ties may be long. The first period
    has no previous one and hence no row.
    """
    listed = top.select(period, item).distinct()
    previous = (
        listed.select(period).distinct()
        .withColumn("__previous", F.lag(period).over(Window.orderBy(period)))
        .where(F.col("__previous").isNotNull())
    )
    current = listed.join(previous, period)
    before = listed.withColumn("__kept", F.lit(1))
    both = equi_join(current, before, [("__previous", period), (item, item)], "left")
    return (
        both.groupBy(period)
        .agg(F.count("__kept").alias("overlap"), F.count_if(F.col("__kept").isNull()).alias("new_entries"))
        .withColumn("pct_overlap", F.col("overlap") / F.lit(float(size)) * 100)
    )


def mean_growth(df: DataFrame, key: str, period: str, value: str, name: str = "mean_growth") -> DataFrame:
    """Average relative change from one present period to the next, per key."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(period))
    return (
        df.withColumn("__growth", ratio(F.col(value), before) - 1)
        .groupBy(key).agg(F.avg("__growth").alias(name))
    )


def absolute_change(series: DataFrame, period: str, value: str, change: str, flag: str) -> DataFrame:
    """|change| from the previous row of a calendar series, flagged above its median.

    The series is bounded by the calendar, so one task and the exact built-in median do.
    """
    moved = series.withColumn(change, F.abs(F.col(value) - F.lag(value).over(Window.orderBy(period))))
    middle = moved.agg(F.median(change)).scalar()
    return moved.withColumn(flag, F.col(change) > middle)


def yearly(df: DataFrame, year: str, keys: Sequence[str], name: str) -> DataFrame:
    """Row count per year and key."""
    return df.groupBy(year, *keys).agg(F.count(F.lit(1)).alias(name))
