"""Payroll analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog import standins as s
from fieldbook.catalog.registry import T_GRID, Tables, query, rounded, with_views
from fieldbook.operators.periods import absolute_change
from fieldbook.plans import payroll

SPLIT_YEAR = 1998


def _payroll(sql: str) -> str:
    return with_views(sql, **s.PAYROLL_VIEWS)


def _combined(t: Tables) -> DataFrame:
    return payroll.combine(s.levels(t), s.revisions(t))


_WELCH = """
sides AS (SELECT count(*) FILTER (g) AS n1, avg(v) FILTER (g) AS m1, var_samp(v) FILTER (g) AS v1,
                 count(*) FILTER (NOT g) AS n2, avg(v) FILTER (NOT g) AS m2, var_samp(v) FILTER (NOT g) AS v2
          FROM (SELECT revision AS v, year(date) >= 1998 AS g FROM combined WHERE revision IS NOT NULL)),
test AS (SELECT (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS statistic, m1 - m2 AS estimate, sqrt(v1 / n1 + v2 / n2) AS se,
                pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS t_df FROM sides),
"""


def _welch(select: str) -> str:
    return with_views("SELECT 1", **s.PAYROLL_VIEWS).rsplit("\nSELECT 1", 1)[0] + "," + _WELCH + T_GRID + "\n" + select


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS level
FROM orders GROUP BY 1""")
def unpivot_months(t: Tables) -> DataFrame:
    """A year x month matrix of texts back into a series."""
    return payroll.levels_from_matrix(s.month_matrix(t))


@query("""
SELECT c_nationkey AS page_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS level
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def html_matrix(t: Tables) -> DataFrame:
    """The same out of the second table of one HTML page per nation."""
    return payroll.levels_from_pages(s.matrix_pages(t))


@query(_payroll("SELECT date, level, original, final, revision FROM combined"))
def series_left_join(t: Tables) -> DataFrame:
    return payroll.newest_first(_combined(t))


@query(_payroll("""
SELECT unnest(['Mean', 'Median', 'Standard Deviation']) AS statistic,
       unnest([round(avg(level), 4), round(median(level), 4), round(stddev_samp(level), 4)]) AS value FROM combined"""))
def long_stats(t: Tables) -> DataFrame:
    return rounded(payroll.level_statistics(_combined(t)), 4, "value")


@query("""
SELECT unnest(['Mean', 'Median', 'Standard Deviation']) AS statistic,
       unnest([round(avg(l_extendedprice), 4), round(median(l_extendedprice), 4), round(stddev_samp(l_extendedprice), 4)]) AS value
FROM lineitem""")
def long_stats_raw(t: Tables) -> DataFrame:
    """The same statistics straight from the largest table."""
    return rounded(payroll.level_statistics(t.lineitem, "l_extendedprice"), 4, "value")


@query(_payroll("""
SELECT unnest(['Proportion of Positive Revisions', 'Proportion of Negative Revisions', 'Proportion of Large Revisions']) AS metric,
       unnest([round(avg(CAST(revision > 0 AS INTEGER)), 8), round(avg(CAST(revision < 0 AS INTEGER)), 8),
               round(avg(CAST(CASE WHEN original = 0 AND revision <> 0 THEN TRUE ELSE abs(revision / nullif(original, 0) * 100) > 50 END AS INTEGER)), 8)]) AS value
FROM combined"""))
def flag_shares(t: Tables) -> DataFrame:
    return rounded(payroll.revision_shares(_combined(t)), 8, "value")


@query(_payroll("""
SELECT date, revision > 0 AS positive_revision, revision < 0 AS negative_revision,
       round(revision / nullif(original, 0) * 100, 4) AS revision_pct,
       CASE WHEN original = 0 AND revision <> 0 THEN TRUE ELSE abs(revision / nullif(original, 0) * 100) > 1 END AS large_revision
FROM combined"""))
def revision_flags(t: Tables) -> DataFrame:
    flags = payroll.with_revision_flags(_combined(t), 1)
    return rounded(flags.drop("level", "original", "final", "revision"), 4, "revision_pct")


@query(_welch("""
SELECT round(test.statistic, 6) AS statistic, round(t_df, 4) AS t_df, round(2 * (1 - p.cdf), 5) AS p_value,
       round(estimate, 4) AS estimate, round((estimate - q.x * se) / 10, 0) AS lower_ci, round((estimate + q.x * se) / 10, 0) AS upper_ci
FROM test,
     (SELECT a.cdf + (b.cdf - a.cdf) * (abs(a.statistic) - a.x) / 0.0005 AS cdf FROM area a JOIN area b ON b.k = a.k + 1
      WHERE abs(a.statistic) >= a.x AND abs(a.statistic) < b.x) p,
     (SELECT a.x + 0.0005 * (0.975 - a.cdf) / (b.cdf - a.cdf) AS x FROM area a JOIN area b ON b.k = a.k + 1
      WHERE a.cdf <= 0.975 AND b.cdf > 0.975) q"""))
def welch_t(t: Tables) -> DataFrame:
    """Interval ends in tens, as the SQL side integrates the density on a grid."""
    test = payroll.revision_t_test(_combined(t), SPLIT_YEAR)
    ends = test.withColumns({c: F.round(F.col(c) / 10, 0) for c in ("lower_ci", "upper_ci")})
    return rounded(rounded(rounded(ends, 6, "statistic"), 4, "t_df", "estimate"), 5, "p_value")


@query(_welch("""
SELECT round(test.statistic, 6) AS statistic, round(t_df, 4) AS t_df,
       round(CASE WHEN test.statistic >= 0 THEN 1 - p.cdf ELSE p.cdf END, 5) AS p_value, round(estimate, 4) AS estimate,
       round((estimate - q.x * se) / 10, 0) AS lower_ci, CAST('Infinity' AS DOUBLE) AS upper_ci
FROM test,
     (SELECT a.cdf + (b.cdf - a.cdf) * (abs(a.statistic) - a.x) / 0.0005 AS cdf FROM area a JOIN area b ON b.k = a.k + 1
      WHERE abs(a.statistic) >= a.x AND abs(a.statistic) < b.x) p,
     (SELECT a.x + 0.0005 * (0.95 - a.cdf) / (b.cdf - a.cdf) AS x FROM area a JOIN area b ON b.k = a.k + 1
      WHERE a.cdf <= 0.95 AND b.cdf > 0.95) q"""))
def welch_t_greater(t: Tables) -> DataFrame:
    test = payroll.revision_t_test(_combined(t), SPLIT_YEAR, "greater")
    ends = test.withColumn("lower_ci", F.round(F.col("lower_ci") / 10, 0))
    return rounded(rounded(rounded(ends, 6, "statistic"), 4, "t_df", "estimate"), 5, "p_value")


@query(_payroll("""
SELECT period_label, "Negative", "Positive", "Negative" + "Positive" AS "Total",
       "Negative" / ("Negative" + "Positive") AS prop_negative, "Positive" / ("Negative" + "Positive") AS prop_positive
FROM (SELECT CASE WHEN year(date) >= 1998 THEN 'Post-1998' ELSE 'Pre-1998' END AS period_label,
             count(*) FILTER (revision < 0) AS "Negative", count(*) FILTER (NOT revision < 0) AS "Positive"
      FROM combined WHERE revision IS NOT NULL GROUP BY 1)"""))
def period_direction_pivot(t: Tables) -> DataFrame:
    return payroll.direction_by_period(_combined(t), SPLIT_YEAR)


@query(_payroll("""
SELECT CASE WHEN year(date) >= 1998 THEN 'Post-1998' ELSE 'Pre-1998' END AS period_label, count(*) AS n,
       round(avg(revision), 4) AS mean, round(stddev_samp(revision), 4) AS sd, round(median(revision), 4) AS median
FROM combined GROUP BY 1"""))
def period_summary(t: Tables) -> DataFrame:
    return rounded(payroll.period_summary(_combined(t), SPLIT_YEAR), 4, "mean", "sd", "median")


@query("""
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd, round(median(value), 4) AS median
FROM events GROUP BY event_type""")
def group_summary(t: Tables) -> DataFrame:
    return rounded(payroll.summary(t.events, "event_type", "value"), 4, "mean", "sd", "median")


@query(_payroll("""
SELECT round(avg(CAST(revision < 0 AS INTEGER)) FILTER (year(date) > 1998) - avg(CAST(revision < 0 AS INTEGER)) FILTER (year(date) <= 1998), 8) AS diff_in_props
FROM combined WHERE revision IS NOT NULL"""))
def diff_in_props(t: Tables) -> DataFrame:
    return rounded(payroll.negative_share_difference(_combined(t), SPLIT_YEAR), 8, "diff_in_props")


@query("""
SELECT period, o_orderstatus, count(*) AS n FROM (
  SELECT CASE WHEN year(o_orderdate) < 1997 THEN 'Pre-1997' WHEN year(o_orderdate) < 2000 THEN '1997-1999' ELSE 'Post-2000' END AS period, o_orderstatus
  FROM orders) GROUP BY ALL""")
def period_buckets(t: Tables) -> DataFrame:
    rows = t.orders.select(payroll.period(F.year("o_orderdate"), 1997, 2000).alias("period"), "o_orderstatus")
    return rows.groupBy("period", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT month, revenue, round(change, 2) AS change, change > median(change) OVER () AS large FROM (
  SELECT month, revenue, abs(revenue - lag(revenue) OVER (ORDER BY month)) AS change FROM (
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100 AS revenue
    FROM lineitem GROUP BY 1))""")
def mom_change(t: Tables) -> DataFrame:
    months = t.lineitem.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month")).agg(
        (F.sum(s.cents("l_extendedprice")) / 100).alias("revenue")
    )
    return rounded(absolute_change(months, "month", "revenue", "change", "large"), 2, "change")
