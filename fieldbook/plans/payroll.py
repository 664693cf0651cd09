"""Payroll levels and their revisions.

Medians go through ``exact_median``, which orders no whole column. Nothing here is sorted but for reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions.dates import parse_year_month
from fieldbook.functions.nulls import if_else
from fieldbook.functions.numbers import exceeds_percent, percent_change, ratio, text_to_double
from fieldbook.functions.text import remove_all
from fieldbook.operators.joins import equi_join
from fieldbook.operators.quantiles import exact_median
from fieldbook.operators.reshape import MONTHS, bin_label, counts_wide, months_to_rows, to_long
from fieldbook.operators.stats import diff_in_props, share, welch_t
from fieldbook.sources.html_tables import html_rows, table_columns


def levels_from_matrix(matrix: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Year x month matrix of numbers with thousands commas to a (date, level) series."""
    long = months_to_rows(matrix.select(*keys, "year", *MONTHS), [*keys, "year"])
    series = long.select(
        *keys,
        parse_year_month("year", "month").alias("date"),
        text_to_double(remove_all("level", ",")).alias("level"),
    )
    return series.na.drop("any")


def levels_from_pages(pages: DataFrame, page_id: str = "page_id", html: str = "html", table: int = 2) -> DataFrame:
    """The series of every page whose given table is a year x month matrix."""
    rows = html_rows(pages, page_id, html)
    matrix = table_columns(rows, F.col("table_idx") == table, [page_id], ["year", *MONTHS])
    return levels_from_matrix(matrix, (page_id,))


def revisions_from_pages(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Revision tables, one per year with the year as table id: rows of month, original,
    final and revision become (date, original, final, revision)."""
    rows = html_rows(pages, page_id, html)
    is_year = F.coalesce(F.col("table_id").rlike("^[0-9]{4}$"), F.lit(False))
    cells = table_columns(rows, is_year, ["table_id"], ["month", "original", "final", "revision"])
    numbers = [text_to_double(remove_all(c, ",")).alias(c) for c in ("original", "final", "revision")]
    return (
        cells.select(parse_year_month("table_id", F.substring("month", 1, 3)).alias("date"), *numbers)
        .where(F.col("date").isNotNull())
    )


def combine(levels: DataFrame, revisions: DataFrame) -> DataFrame:
    """Levels with their revisions; dates without a revision stay."""
    return equi_join(levels, revisions, ["date"], "left")


def newest_first(series: DataFrame) -> DataFrame:
    """For reports: analyses take the series unsorted."""
    return series.orderBy(F.desc_nulls_last("date"))


def level_statistics(series: DataFrame, value: str = "level") -> DataFrame:
    """Mean, median and standard deviation of a column of any size as (statistic, value) rows."""
    moments = series.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    middle = exact_median(series, value).scalar()
    names = {"mean": "Mean", "median": "Median", "sd": "Standard Deviation"}
    return to_long(moments.withColumn("median", middle), names, "statistic", "value")


def with_revision_flags(combined: DataFrame, threshold: float = 50) -> DataFrame:
    return combined.withColumns({
        "positive_revision": F.col("revision") > 0,
        "negative_revision": F.col("revision") < 0,
        "revision_pct": percent_change("revision", "original"),
        "large_revision": exceeds_percent("revision", "original", threshold),
    })


def revision_shares(combined: DataFrame, threshold: float = 50) -> DataFrame:
    flags = with_revision_flags(combined, threshold).agg(
        *[share(F.col(c)).alias(c) for c in ("positive_revision", "negative_revision", "large_revision")]
    )
    return to_long(flags, {
        "positive_revision": "Proportion of Positive Revisions",
        "negative_revision": "Proportion of Negative Revisions",
        "large_revision": "Proportion of Large Revisions",
    }, "metric", "value")


def revision_t_test(combined: DataFrame, from_year: int = 2020, alternative: str = "two-sided") -> DataFrame:
    """Welch test of revisions from a year on against those before it."""
    return welch_t(combined, "revision", F.year("date") >= from_year, alternative)


def period(year: str | Column, first: int = 2000, second: int = 2020) -> Column:
    """Three period labels around two years; an unknown year has none."""
    label = bin_label(
        year,
        [(float("-inf"), first - 1, f"Pre-{first}"), (first, second - 1, f"{first}-{second - 1}")],
        f"Post-{second}",
    )
    y = F.col(year) if isinstance(year, str) else year
    return F.when(y.isNotNull(), label)


def direction_by_period(combined: DataFrame, from_year: int = 2000) -> DataFrame:
    """Counts and shares of negative and positive revisions before and after a year."""
    post, negative = F.year("date") >= from_year, F.col("revision") < 0
    rows = combined.select(post.alias("post"), negative.alias("negative")).na.drop("any").select(
        if_else(F.col("post"), F.lit(f"Post-{from_year}"), F.lit(f"Pre-{from_year}")).alias("period_label"),
        if_else(F.col("negative"), F.lit("Negative"), F.lit("Positive")).alias("direction"),
    )
    wide = counts_wide(rows, ["period_label"], "direction", ["Negative", "Positive"])
    return wide.withColumn("Total", F.col("Negative") + F.col("Positive")).withColumns({
        "prop_negative": ratio("Negative", "Total"),
        "prop_positive": ratio("Positive", "Total"),
    })


def period_summary(combined: DataFrame, from_year: int = 2020) -> DataFrame:
    """Number of rows, mean, standard deviation and median of revisions before and after a year."""
    labelled = combined.where(F.col("date").isNotNull()).withColumn(
        "period_label", if_else(F.year("date") >= from_year, F.lit(f"Post-{from_year}"), F.lit(f"Pre-{from_year}"))
    )
    return summary(labelled, "period_label", "revision")


def summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """n, mean, sd and exact median of a column per group, for groups of any size."""
    moments = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    return equi_join(moments, exact_median(df, value, [key]), [key], "left")


def negative_share_difference(combined: DataFrame, after_year: int = 2000) -> DataFrame:
    """Share of negative revisions after a year minus the share up to it, complete rows only."""
    complete = combined.na.drop("any")
    return diff_in_props(complete, F.col("revision") < 0, F.year("date") > after_year)
