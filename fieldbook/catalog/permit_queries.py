"""Permit analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog import standins as s
from fieldbook.catalog.registry import T_GRID, Tables, query, rounded, with_views
from fieldbook.operators.groups import with_first_value, with_group_sizes, with_group_values
from fieldbook.operators.joins import natural_full_join as full_join
from fieldbook.operators.periods import mean_growth, overlap_with_previous, yearly
from fieldbook.operators.ranking import first_per_key as first_rows, top_n_per_group
from fieldbook.operators.reshape import split_to_rows as split_rows
from fieldbook.operators.stats import ols_line
from fieldbook.plans import permits


def _permits(sql: str) -> str:
    return with_views(sql, **s.ROW_VIEWS)


NAMES = {"10010": "Harbour, North", "10011": "Mill's Corner", "10012": "Station", "10999": "Nowhere"}
_NAMES_SQL = "(VALUES ('10010', 'Harbour, North'), ('10011', 'Mill''s Corner'), ('10012', 'Station'), ('10999', 'Nowhere')) names(zip, neighborhood)"


@query(with_views("SELECT * FROM permits", **s.PERMIT_VIEWS))
def clean_permits(t: Tables) -> DataFrame:
    return permits.clean_permits(
        s.permits_newest(t), s.permits_mid(t), s.permits_oldest(t), s.OLDEST_ORDER, "1995-06-01", "2001-06-30"
    )


@query(_permits("SELECT start_year, count(*) AS total_permits FROM permits GROUP BY start_year"))
def permits_per_year(t: Tables) -> DataFrame:
    return permits.per_year(s.permit_rows(t))


@query(_permits("SELECT borough, count(*) AS total_permits FROM permits GROUP BY borough"))
def permits_per_borough(t: Tables) -> DataFrame:
    return permits.per_borough(s.permit_rows(t))


@query(with_views("""
SELECT a.start_year, count(b.zip) AS overlap, count(*) FILTER (b.zip IS NULL) AS new_entries, count(b.zip) / 10 * 100 AS pct_overlap
FROM (SELECT top.start_year, zip, previous FROM top JOIN (
        SELECT start_year, lag(start_year) OVER (ORDER BY start_year) AS previous FROM (SELECT DISTINCT start_year FROM top)) y
      ON y.start_year = top.start_year WHERE previous IS NOT NULL) a
LEFT JOIN top b ON b.start_year = a.previous AND b.zip = a.zip
GROUP BY a.start_year""", **s.ROW_VIEWS, top="""
SELECT start_year, coalesce(zipcode, '?') AS zip, count(*) AS productions FROM permits GROUP BY start_year, zipcode
QUALIFY rank() OVER (PARTITION BY start_year ORDER BY count(*) DESC) <= 10"""))
def hotspot_overlap(t: Tables) -> DataFrame:
    return permits.hotspot_overlap(s.permit_rows(t))


@query(_permits(f"""
SELECT start_year, zipcode, productions, neighborhood FROM (
  SELECT start_year, zipcode, count(*) AS productions FROM permits
  WHERE start_year <> 1997 AND zipcode IN ('10010', '10011', '10012', '10999') GROUP BY ALL)
LEFT JOIN {_NAMES_SQL} ON zip = zipcode"""))
def lookup_names(t: Tables) -> DataFrame:
    return permits.named_hotspots(s.permit_rows(t), NAMES, [1997])


# Two-sided, from the grid; beyond its end the rest is 0 to more digits than are compared.
_P_VALUE = """coalesce((SELECT 2 * (1 - (a.cdf + (b.cdf - a.cdf) * (abs(a.statistic) - a.x) / 0.0005)) FROM area a JOIN area b ON b.k = a.k + 1
                 WHERE abs(a.statistic) >= a.x AND abs(a.statistic) < b.x), 0.0)"""


@query(_permits(f"""
, fit AS (SELECT count(*) AS n, corr(a, b) AS r FROM (
    SELECT start_year, count(*) FILTER (zipcode = '10010') AS a, count(*) FILTER (borough = 'BUILDING') AS b
    FROM permits WHERE start_year <> 1997 GROUP BY start_year) WHERE a > 0 AND b > 0),
test AS (SELECT r * sqrt((n - 2) / (1 - r * r)) AS statistic, CAST(n - 2 AS DOUBLE) AS t_df FROM fit),
{T_GRID}
SELECT n, round_even(r, 3) AS correlation, round_even(r * r, 3) AS r_squared, round_even({_P_VALUE}, 4) AS p_value FROM fit"""))
def zip_against_borough(t: Tables) -> DataFrame:
    return permits.zip_against_borough(s.permit_rows(t), "10010", "BUILDING", [1997])


@query(_permits("SELECT count(DISTINCT zipcode) + max(CAST(zipcode IS NULL AS INTEGER)) AS zipcodes FROM permits"))
def distinct_zipcodes(t: Tables) -> DataFrame:
    return permits.distinct_zipcodes(s.permit_rows(t))


@query(_permits("""
SELECT zipcode, round(avg(growth), 6) AS mean_growth FROM (
  SELECT zipcode, productions / lag(productions) OVER (PARTITION BY zipcode ORDER BY start_year) - 1 AS growth
  FROM (SELECT zipcode, start_year, count(*) AS productions FROM permits GROUP BY ALL)) GROUP BY zipcode"""))
def zip_growth(t: Tables) -> DataFrame:
    return rounded(permits.zip_growth(s.permit_rows(t)), 6, "mean_growth")


_LEFT = "SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_RIGHT = "SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'"


@query(with_views("""
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
       coalesce(a.priority, b.priority) AS priority, o_totalprice, o_custkey
FROM l a FULL JOIN r b ON a.o_orderkey = b.o_orderkey AND a.o_orderstatus = b.o_orderstatus AND a.priority IS NOT DISTINCT FROM b.priority""",
    l=_LEFT, r=_RIGHT))
def natural_full_join(t: Tables) -> DataFrame:
    """Two overlapping order files with partly shared columns and NULLs among the keys."""
    orders = t.orders.withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    left = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    right = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return full_join(
        left.select("o_orderkey", "o_orderstatus", "priority", "o_totalprice"),
        right.select("o_orderkey", "o_orderstatus", "priority", "o_custkey"),
    )


_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE)}) = 1""")
def first_per_key(t: Tables) -> DataFrame:
    return first_rows(t.lineitem, ["l_orderkey"], _LINE)


@query("""
SELECT code, count(*) AS n FROM (SELECT unnest([l_returnflag, l_linestatus]) AS code FROM lineitem) GROUP BY code""")
def split_to_rows(t: Tables) -> DataFrame:
    cells = t.lineitem.select(F.concat("l_returnflag", F.lit(", "), "l_linestatus").alias("code"))
    return split_rows(cells, "code").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n_customer, count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS n_year,
       count(*) OVER (PARTITION BY o_custkey, year(o_orderdate), month(o_orderdate)) AS n_month FROM orders""")
def group_sizes(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    sized = with_group_sizes(rows, ["o_custkey", "y", "m"], {
        "n_customer": ["o_custkey"], "n_year": ["o_custkey", "y"], "n_month": ["o_custkey", "y", "m"],
    })
    return sized.drop("o_custkey", "y", "m")


@query("""
SELECT o_orderkey, o_custkey, avg(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey) AS mean_cents FROM orders""")
def group_mean_rows(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", s.cents("o_totalprice").alias("c"))
    return with_group_values(rows, ["o_custkey"], mean_cents=F.avg("c")).drop("c")


@query("""
SELECT o_orderkey, first_week, first_rank FROM (
  SELECT o_orderkey, min(CAST(o_orderdate AS DATE)) OVER w AS first_week,
         first_value(CAST(left(o_orderpriority, 1) AS INTEGER)) OVER (w ORDER BY CAST(o_orderdate AS DATE), left(o_orderpriority, 1)) AS first_rank
  FROM orders WINDOW w AS (PARTITION BY o_custkey))""")
def first_value_rows(t: Tables) -> DataFrame:
    """First day of each customer and the rank on it, on every order."""
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("week"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"),
    )
    return with_first_value(rows, ["o_custkey"], "week", "rank", "first_week", "first_rank").select(
        "o_orderkey", "first_week", "first_rank"
    )


@query("""
SELECT category_number, concat('Decile ', CAST(category_number AS VARCHAR)) AS category, round(sum(total), 2) AS total_value, count(*) AS num_customers
FROM (SELECT total, CAST(greatest(1, len(list_filter(edges, lambda e: e < total))) AS INTEGER) AS category_number
      FROM totals, (SELECT quantile_cont(total, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges FROM totals))
GROUP BY ALL""".replace("\nSELECT", """
WITH totals AS (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100 AS total FROM orders GROUP BY o_custkey)
SELECT""", 1))
def decile_concentration(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg((F.sum(s.cents("o_totalprice")) / 100).alias("total"))
    return rounded(permits.decile_concentration(totals, "total", "total_value", "num_customers"), 2, "total_value")


@query(_permits("""
, totals AS (SELECT zipcode, count(*) AS productions FROM permits GROUP BY zipcode),
edges AS (SELECT quantile_cont(productions, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges FROM totals)
SELECT category_number, concat('Decile ', CAST(category_number AS VARCHAR)) AS category, CAST(sum(productions) AS BIGINT) AS total_productions,
       count(*) AS num_zip_codes
FROM (SELECT productions, CAST(greatest(1, len(list_filter(edges, lambda e: e < productions))) AS INTEGER) AS category_number FROM totals, edges)
GROUP BY ALL"""))
def zip_deciles(t: Tables) -> DataFrame:
    """Permits per zip code in bins of zip codes."""
    return permits.zip_deciles(s.permit_rows(t))


_TOP_PARTS = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_partkey, count(*) AS n FROM lineitem GROUP BY year(l_shipdate), l_partkey
QUALIFY rank() OVER (PARTITION BY year(l_shipdate) ORDER BY count(*) DESC) <= 10"""


@query(with_views("SELECT year, l_partkey, n, CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, l_partkey) AS INTEGER) AS rank FROM top",
                  top=_TOP_PARTS))
def top_per_year(t: Tables) -> DataFrame:
    counts = yearly(t.lineitem.withColumn("year", F.year("l_shipdate")), "year", ["l_partkey"], "n")
    return permits.top_per_year(counts, "year", "l_partkey", "n")


@query(with_views("""
SELECT a.year, count(b.l_partkey) AS overlap, count(*) - count(b.l_partkey) AS new_entries, count(b.l_partkey) / 10 * 100 AS pct_overlap
FROM top a LEFT JOIN top b ON b.year = a.year - 1 AND b.l_partkey = a.l_partkey
WHERE a.year > (SELECT min(year) FROM top) GROUP BY a.year""", top=_TOP_PARTS))
def top10_overlap(t: Tables) -> DataFrame:
    counts = yearly(t.lineitem.withColumn("year", F.year("l_shipdate")), "year", ["l_partkey"], "n")
    return overlap_with_previous(top_n_per_group(counts, ["year"], "n", 10), "year", "l_partkey", 10)


@query("""
SELECT c_mktsegment, round(avg(growth), 6) AS mean_growth FROM (
  SELECT c_mktsegment, n / lag(n) OVER (PARTITION BY c_mktsegment ORDER BY y) - 1 AS growth
  FROM (SELECT c_mktsegment, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL))
GROUP BY c_mktsegment""")
def yoy_growth(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    counts = yearly(rows.withColumn("y", F.year("o_orderdate")), "y", ["c_mktsegment"], "n")
    return rounded(mean_growth(counts, "c_mktsegment", "y", "n"), 6, "mean_growth")


@query(f"""
WITH fit AS (
  SELECT count(*) AS n, regr_slope(a, b) AS slope, regr_intercept(a, b) AS intercept, corr(a, b) AS correlation, regr_r2(a, b) AS r_squared
  FROM (SELECT year(o_orderdate) AS y, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus = 'O') AS b
        FROM orders GROUP BY 1)),
test AS (SELECT correlation * sqrt((n - 2) / (1 - r_squared)) AS statistic, CAST(n - 2 AS DOUBLE) AS t_df FROM fit),
{T_GRID}
SELECT n, round(slope, 8) AS slope, round(intercept, 4) AS intercept, round(correlation, 8) AS correlation, round(r_squared, 8) AS r_squared,
       round(2 * (1 - p.cdf), 5) AS p_value
FROM fit,
     (SELECT a.cdf + (b.cdf - a.cdf) * (abs(a.statistic) - a.x) / 0.0005 AS cdf FROM area a JOIN area b ON b.k = a.k + 1
      WHERE abs(a.statistic) >= a.x AND abs(a.statistic) < b.x) p""")
def correlation_years(t: Tables) -> DataFrame:
    pair = permits.yearly_pair(
        t.orders.withColumn("start_year", F.year("o_orderdate")),
        F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O", ("a", "b"), (),
    )
    line = rounded(ols_line(pair, "a", "b"), 5, "p_value")
    return rounded(rounded(line, 8, "slope", "correlation", "r_squared"), 4, "intercept")


@query(f"""
WITH fit AS (
  SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
         regr_r2(l_extendedprice, l_quantity) AS r_squared FROM lineitem),
test AS (SELECT sqrt(r_squared * (n - 2) / (1 - r_squared)) AS statistic, CAST(n - 2 AS DOUBLE) AS t_df FROM fit),
{T_GRID}
SELECT n, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r_squared, 8) AS r_squared, round({_P_VALUE}, 5) AS p_value FROM fit""")
def fit_line(t: Tables) -> DataFrame:
    line = ols_line(t.lineitem, "l_extendedprice", "l_quantity").select("n", "slope", "intercept", "r_squared", "p_value")
    return rounded(rounded(rounded(rounded(line, 6, "slope"), 4, "intercept"), 8, "r_squared"), 5, "p_value")
