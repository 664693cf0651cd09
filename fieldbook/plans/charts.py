"""Weekly Top-10 charts, worldwide and per country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook import schemas
from fieldbook.functions.dates import year_week_label
from fieldbook.functions.nulls import blank_to_null, n_distinct, strict_max, strict_sum, sum_or_zero
from fieldbook.functions.numbers import minutes
from fieldbook.operators.groups import first_of_group
from fieldbook.operators.ranking import at_extremes, latest, top_n, top_n_per_group, top_one_per_group
from fieldbook.operators.reshape import report
from fieldbook.operators.sets import count_groups
from fieldbook.sources.delimited import read_tsv


def read_global(spark: SparkSession, path: str) -> DataFrame:
    return clean_global(read_tsv(spark, path, schemas.GLOBAL_CHART))


def read_country(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.COUNTRY_CHART, null_marker="N/A")


def clean_global(chart: DataFrame) -> DataFrame:
    return chart.withColumn("season_title", blank_to_null("season_title", "N/A"))


def preview(chart: DataFrame, order: Sequence[Column], n: int = 20) -> DataFrame:
    """First rows as a report, run time in minutes."""
    rows = chart.withColumn("runtime_(minutes)", minutes("runtime")).drop("season_title")
    return report(rows, n, order)


def countries(chart: DataFrame) -> DataFrame:
    return count_groups(chart, "country_name", "number")


def longest_charting(chart: DataFrame, category: str) -> DataFrame:
    """Title(s) of a category with the most cumulative weeks."""
    rows = chart.where(F.col("category") == category)
    return top_n(rows.select("show_title", "category", "cumulative_weeks_in_top_10"), "cumulative_weeks_in_top_10")


def longest_film(chart: DataFrame, categories: Sequence[str]) -> DataFrame:
    films = chart.where(F.col("category").isin(list(categories))).select(
        "show_title", minutes("runtime").alias("runtime_minutes"), "category"
    )
    return top_n(films, "runtime_minutes")


def best_week_per_category(chart: DataFrame) -> DataFrame:
    rows = chart.select("show_title", "weekly_hours_viewed", "category")
    return top_n_per_group(rows, ["category"], "weekly_hours_viewed")


def best_total_per_category(chart: DataFrame) -> DataFrame:
    totals = chart.groupBy("category", "show_title").agg(sum_or_zero("weekly_hours_viewed").alias("total_hours"))
    return top_one_per_group(totals, ["category"], "total_hours", ["show_title"])


def longest_country_run(chart: DataFrame, category: str) -> DataFrame:
    rows = chart.where(F.col("category") == category)
    return top_n(
        rows.select("country_name", "category", "show_title", "cumulative_weeks_in_top_10"),
        "cumulative_weeks_in_top_10",
    )


def short_histories(chart: DataFrame, fewer_than: int, key: str = "country_name") -> DataFrame:
    """Countries with less than a number of distinct year-week labels."""
    weeks = chart.select(key, year_week_label("week").alias("label"))
    return weeks.groupBy(key).agg(n_distinct("label").alias("total_weeks")).where(F.col("total_weeks") < fewer_than)


def last_week(chart: DataFrame, country: str, tie_break: Sequence[str] = ()) -> DataFrame:
    rows = chart.where(F.col("country_name") == country)
    return latest(rows.select("country_name", "week", *tie_break), "week", tie_break)


def title_hours(chart: DataFrame, title: str) -> DataFrame:
    """Total hours of a title: per season first, then over the seasons."""
    seasons = (
        chart.where(F.col("show_title") == title)
        .groupBy("season_title").agg(strict_sum("weekly_hours_viewed").alias("hours"))
    )
    return seasons.agg(strict_sum("hours").alias("total_hours"))


def title_hours_matching(chart: DataFrame, pattern: str) -> DataFrame:
    """Total hours of all titles that match a pattern."""
    titles = (
        chart.where(F.col("show_title").rlike(pattern))
        .groupBy("show_title").agg(strict_sum("weekly_hours_viewed").alias("hours"))
    )
    return titles.agg(strict_sum("hours").alias("total_hours"))


def views_in_year(chart: DataFrame, title: str, year: int, runtime_hours: float = 118 / 60) -> DataFrame:
    """Views = hours / run time in one year (default run time 1 h 58 min)."""
    rows = chart.where((F.col("show_title") == title) & (F.year("week") == year))
    views = rows.select((F.col("weekly_hours_viewed") / F.lit(runtime_hours)).alias("views"))
    return views.agg(strict_sum("views").alias("total_views"))


def climbed_to_top(chart: DataFrame, country: str, category: str) -> DataFrame:
    """Titles that reached rank 1 in a country but entered lower.

    One aggregate per title decides both conditions; no row-level window is needed.
    """
    rows = chart.where((F.col("country_name") == country) & (F.col("category") == category))
    first = first_of_group("week", "weekly_rank", "first_week", "first_rank")
    titles = rows.groupBy("show_title").agg(
        first["first_rank"].alias("first_rank"),
        F.count_if(F.col("weekly_rank") == 1).alias("weeks_on_top"),
    )
    return titles.where("weeks_on_top > 0 and first_rank > 1").select("show_title")


def debut_countries(chart: DataFrame, category: str) -> DataFrame:
    """Countries per title and season (each counted once, with its debut), most first."""
    rows = chart.where(F.col("category") == category)
    return countries_per_title(debuts(rows)).orderBy(F.desc("countries"), "show_title", "season_title")


def debuts(rows: DataFrame) -> DataFrame:
    """First week and rank of each title and season in each country."""
    first = first_of_group("week", "weekly_rank", "first_week", "first_rank")
    return rows.groupBy("show_title", "season_title", "country_name").agg(
        *[c.alias(name) for name, c in first.items()]
    )


def countries_per_title(debut_rows: DataFrame) -> DataFrame:
    return debut_rows.groupBy("show_title", "season_title").agg(F.count(F.lit(1)).alias("countries"))


def first_and_last_week(chart: DataFrame) -> DataFrame:
    return at_extremes(chart, "week")


def longest_run_per_country(chart: DataFrame, title: str, category: str) -> DataFrame:
    rows = chart.where((F.col("category") == category) & (F.col("show_title") == title))
    return rows.groupBy("country_name").agg(strict_max("cumulative_weeks_in_top_10").alias("weeks"))


def charting_weeks(chart: DataFrame, title: str) -> DataFrame:
    """Number of distinct charting weeks of a title per country, most first."""
    weeks = chart.where(F.col("show_title") == title).groupBy("country_name", "week").agg(F.count(F.lit(1)))
    return (
        weeks.groupBy("country_name").agg(F.count(F.lit(1)).alias("weeks"))
        .orderBy(F.desc("weeks"), "country_name")
    )
