"""Chart analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog.registry import Tables, query, rounded, with_views
from fieldbook.catalog.standins import COUNTRY_CHART, GLOBAL_CHART, country_chart, global_chart
from fieldbook.plans import charts


def _global(sql: str) -> str:
    return with_views(sql, chart=GLOBAL_CHART)


def _country(sql: str) -> str:
    return with_views(sql, chart=COUNTRY_CHART)


def clean(t: Tables) -> DataFrame:
    return charts.clean_global(global_chart(t))


@query(_global("""
SELECT week AS "Week", category AS "Category", weekly_rank AS "Weekly Rank", show_title AS "Show Title",
       weekly_hours_viewed AS "Weekly Hours Viewed", runtime AS "Runtime", weekly_views AS "Weekly Views",
       cumulative_weeks_in_top_10 AS "Cumulative Weeks In Top 10", round_even(runtime * 60, 0) AS "Runtime (minutes)"
FROM chart ORDER BY weekly_hours_viewed DESC, week, show_title, weekly_rank, category LIMIT 20"""))
def report_projection(t: Tables) -> DataFrame:
    order = [F.desc("weekly_hours_viewed"), F.asc("week"), F.asc("show_title"), F.asc("weekly_rank"), F.asc("category")]
    return charts.preview(clean(t), order)


@query(_country("SELECT count(*) AS number FROM (SELECT country_name FROM chart GROUP BY country_name)"))
def distinct_groups(t: Tables) -> DataFrame:
    return charts.countries(country_chart(t))


@query(_global("""
SELECT show_title, category, cumulative_weeks_in_top_10 FROM chart WHERE category = 'SMALL'
QUALIFY rank() OVER (ORDER BY cumulative_weeks_in_top_10 DESC) = 1"""))
def global_top_ties(t: Tables) -> DataFrame:
    return charts.longest_charting(clean(t), "SMALL")


@query(_global("""
SELECT show_title, round_even(runtime * 60, 0) AS runtime_minutes, category FROM chart
WHERE category IN ('ECONOMY', 'SMALL') QUALIFY rank() OVER (ORDER BY runtime_minutes DESC) = 1"""))
def longest_film(t: Tables) -> DataFrame:
    return charts.longest_film(clean(t), ["ECONOMY", "SMALL"])


@query(_global("""
SELECT show_title, weekly_hours_viewed, category FROM chart
QUALIFY rank() OVER (PARTITION BY category ORDER BY weekly_hours_viewed DESC) = 1"""))
def top_single_per_category(t: Tables) -> DataFrame:
    return charts.best_week_per_category(clean(t))


@query(_global("""
SELECT category, show_title, CAST(sum(weekly_hours_viewed) AS BIGINT) AS total_hours FROM chart GROUP BY category, show_title
QUALIFY row_number() OVER (PARTITION BY category ORDER BY total_hours DESC, show_title) = 1"""))
def top_total_per_category(t: Tables) -> DataFrame:
    return charts.best_total_per_category(clean(t))


@query(_country("""
SELECT country_name, category, show_title, cumulative_weeks_in_top_10 FROM chart WHERE category = 'TV'
QUALIFY rank() OVER (ORDER BY cumulative_weeks_in_top_10 DESC) = 1"""))
def country_longest_run(t: Tables) -> DataFrame:
    return charts.longest_country_run(country_chart(t), "TV")


@query(with_views("""
SELECT o_custkey, count(DISTINCT concat(CAST(year(d) AS VARCHAR), '-', lpad(CAST(week(d) AS VARCHAR), 2, '0'))) AS total_weeks
FROM orders_days GROUP BY o_custkey HAVING total_weeks < 9""",
    orders_days="SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders"))
def iso_week_counts(t: Tables) -> DataFrame:
    days = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("week"))
    return charts.short_histories(days, 9, "o_custkey")


@query(_country("""
SELECT country_name, week, o_orderkey FROM chart WHERE country_name = 'NATION_7'
ORDER BY week DESC, o_orderkey LIMIT 1"""))
def latest_row(t: Tables) -> DataFrame:
    return charts.last_week(country_chart(t), "NATION_7", ["o_orderkey"])


@query(_global("""
SELECT coalesce(CAST(sum(weekly_hours_viewed) AS BIGINT), 0) AS total_hours FROM chart WHERE show_title = 'red widget'"""))
def title_total(t: Tables) -> DataFrame:
    return charts.title_hours(clean(t), "red widget")


@query(_global("""
SELECT coalesce(CAST(sum(weekly_hours_viewed) AS BIGINT), 0) AS total_hours FROM chart
WHERE regexp_matches(show_title, '^(red|hot) .*r$')"""))
def regex_total(t: Tables) -> DataFrame:
    return charts.title_hours_matching(clean(t), "^(red|hot) .*r$")


@query(_global("""
SELECT round(coalesce(sum(weekly_hours_viewed / (CAST(118 AS DOUBLE) / 60)), 0), 3) AS total_views FROM chart
WHERE show_title = 'small ring' AND year(week) = 1998"""))
def ratio_in_year(t: Tables) -> DataFrame:
    return rounded(charts.views_in_year(clean(t), "small ring", 1998), 3, "total_views")


@query(_country("""
SELECT show_title FROM (
  SELECT show_title, weekly_rank, first_value(weekly_rank) OVER (PARTITION BY show_title ORDER BY week, weekly_rank) AS first_rank
  FROM chart WHERE country_name = 'NATION_3' AND category = 'Films')
GROUP BY show_title HAVING bool_or(weekly_rank = 1) AND max(first_rank) > 1"""))
def climbed_to_top(t: Tables) -> DataFrame:
    return charts.climbed_to_top(country_chart(t), "NATION_3", "Films")


@query(_country("""
SELECT show_title, season_title, count(*) AS countries
FROM (SELECT DISTINCT show_title, season_title, country_name FROM chart WHERE category = 'TV') GROUP BY ALL"""))
def debut_spread(t: Tables) -> DataFrame:
    return charts.debut_countries(country_chart(t), "TV")


@query(_country("""
SELECT show_title, season_title, country_name, min(week) AS first_week, arg_min(weekly_rank, (week, weekly_rank)) AS first_rank
FROM chart GROUP BY ALL"""))
def debut_rows(t: Tables) -> DataFrame:
    return charts.debuts(country_chart(t))


@query(_country("""
SELECT country_name, week, o_orderkey FROM chart
WHERE week = (SELECT min(week) FROM chart) OR week = (SELECT max(week) FROM chart)"""))
def rows_at_extremes(t: Tables) -> DataFrame:
    return charts.first_and_last_week(country_chart(t)).select("country_name", "week", "o_orderkey")


@query(_country("""
SELECT country_name, max(cumulative_weeks_in_top_10) AS weeks FROM chart
WHERE category = 'TV' AND show_title = 'Title 17' GROUP BY country_name"""))
def max_per_group(t: Tables) -> DataFrame:
    return charts.longest_run_per_country(country_chart(t), "Title 17", "TV")


@query(_country("""
SELECT country_name, count(DISTINCT week) AS weeks FROM chart WHERE show_title = 'Title 17' GROUP BY country_name"""))
def charting_weeks(t: Tables) -> DataFrame:
    return charts.charting_weeks(country_chart(t), "Title 17")
