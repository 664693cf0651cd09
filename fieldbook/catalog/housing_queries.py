"""Housing, income and wage analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog import standins as s
from fieldbook.catalog.registry import Tables, query, rounded, with_views
from fieldbook.functions.dates import week_start
from fieldbook.functions.numbers import text_to_int
from fieldbook.operators.sets import years
from fieldbook.plans import housing
from fieldbook.sources.fixed_width import cut, lines_of, pair_by_position, permit_sheet as read_sheet, permit_table


def _areas(sql: str) -> str:
    return with_views(sql, **s.AREA_VIEWS, area_permits=s.AREA_PERMITS)


def _wages(sql: str) -> str:
    return with_views(sql, **s.WAGE_VIEWS)


def _measure(t: Tables, name: str) -> DataFrame:
    return housing.measure(s.area_measures(t), name)


def _wage_table(t: Tables) -> DataFrame:
    return housing.clean_wages(s.wages_raw(t))


@query(with_views("""
SELECT l1.title AS level1_title, l2.title AS level2_title, l3.title AS level3_title, l4.title AS level4_title,
       CAST(l1.code AS INTEGER) AS level1_code, CAST(l2.code AS INTEGER) AS level2_code,
       CAST(l3.code AS INTEGER) AS level3_code, CAST(l4.code AS INTEGER) AS level4_code
FROM titles l4 JOIN titles l1 ON l1.code = left(l4.code, 2) JOIN titles l2 ON l2.code = left(l4.code, 3)
     JOIN titles l3 ON l3.code = left(l4.code, 4)
WHERE length(l4.code) = 5""",
    listing=s.INDUSTRY_LISTING,
    titles="""
SELECT code, concat('Group of ', code) AS title FROM listing WHERE length(code) <= 5
UNION ALL SELECT * FROM (VALUES ('31', 'Manufacturing'), ('32', 'Manufacturing'), ('33', 'Manufacturing'), ('44', 'Retail'),
  ('45', 'Retail'), ('48', 'Transportation and Warehousing'), ('49', 'Transportation and Warehousing'))"""))
def hierarchy_levels(t: Tables) -> DataFrame:
    return housing.industry_hierarchy(housing.industry_titles(s.industry_listing(t)))


@query(_areas("""
SELECT name, CAST(sum(new_housing_units_permitted) AS BIGINT) AS decade_totals
FROM area_permits p JOIN population g ON p.cbsa = g.geoid AND p.year = g.year
WHERE p.year BETWEEN 1996 AND 1999 GROUP BY name QUALIFY rank() OVER (ORDER BY decade_totals DESC) <= 5"""))
def decade_winner(t: Tables) -> DataFrame:
    return housing.most_permits(s.area_permits(t), _measure(t, "population"), 1996, 1999, 5)


@query(_areas("""
SELECT round(avg(new_housing_units_permitted / nullif(population, 0)), 6) AS adjustment
FROM area_permits p JOIN population g ON p.cbsa = g.geoid AND p.year = g.year
WHERE p.cbsa = 42 AND p.year IN (1996, 1997, 1999, 2000)"""))
def rate_mean(t: Tables) -> DataFrame:
    result = housing.permit_rate(s.area_permits(t), _measure(t, "population"), "42", [1996, 1997, 1999, 2000])
    return rounded(result, 6, "adjustment")


@query(_areas("""
SELECT p.cbsa, CASE WHEN p.year = 1998 THEN 450 ELSE new_housing_units_permitted END AS new_housing_units_permitted,
       p.year, g.name, g.population
FROM area_permits p JOIN population g ON p.cbsa = g.geoid AND p.year = g.year WHERE p.cbsa = 42
QUALIFY rank() OVER (ORDER BY CASE WHEN p.year = 1998 THEN 450 ELSE new_housing_units_permitted END DESC) = 1"""))
def point_fix_peak(t: Tables) -> DataFrame:
    return housing.peak_permit_year(s.area_permits(t), _measure(t, "population"), "42", 1998, 450)


@query(_areas("""
SELECT state, total_population, round(total_income, 2) AS total_income,
       round(total_income / nullif(total_population, 0), 4) AS individual_income
FROM (SELECT nullif(regexp_extract(name, ', (.{2})', 1), '') AS state,
             CASE WHEN count(population) = count(*) THEN sum(population) END AS total_population,
             CASE WHEN count(household_income * households) = count(*) THEN sum(household_income * households) END AS total_income
      FROM income LEFT JOIN households USING (geoid, name, year) LEFT JOIN population USING (geoid, name, year)
      WHERE year = 1998 GROUP BY 1)
QUALIFY rank() OVER (ORDER BY total_income / total_population DESC NULLS LAST) <= 5"""))
def state_income(t: Tables) -> DataFrame:
    result = housing.state_income(
        _measure(t, "household_income"), _measure(t, "households"), _measure(t, "population"), 1998, 5
    )
    return rounded(rounded(result, 2, "total_income"), 4, "individual_income")


@query(_wages("""
SELECT year, fips, employment FROM (
  SELECT * FROM wages WHERE industry = 60 QUALIFY rank() OVER (PARTITION BY year ORDER BY employment DESC) = 1)
WHERE fips = 'C1007' ORDER BY year DESC LIMIT 1"""))
def area_leads_last_year(t: Tables) -> DataFrame:
    return housing.last_year_leading(_wage_table(t), "C1007", 60)


@query(_wages("""
SELECT year, sector_wages, all_wages, round(sector_wages / all_wages, 8) AS wage_share
FROM (SELECT year, sum(total_wages) FILTER (industry = 60) AS sector_wages, sum(total_wages) AS all_wages
      FROM wages WHERE fips = 'C1007' GROUP BY year)
QUALIFY rank() OVER (ORDER BY sector_wages / all_wages DESC NULLS LAST) = 1"""))
def sector_share_peak(t: Tables) -> DataFrame:
    return rounded(housing.sector_share_peak(_wage_table(t), "C1007", 60), 8, "wage_share")


@query(_wages("SELECT year, fips, industry, employment, total_wages, round(avg_wage, 6) AS avg_wage FROM wages"))
def wage_table(t: Tables) -> DataFrame:
    return rounded(_wage_table(t), 6, "avg_wage")


@query(_wages("""
SELECT year, employment, link, n_name FROM
  (SELECT year, employment, CAST(regexp_replace(fips, '[^0-9]', '') AS DOUBLE) AS link FROM wages WHERE industry = 60)
  JOIN nation ON n_nationkey + 1000 = link"""))
def derived_key_join(t: Tables) -> DataFrame:
    nations = t.nation.select((F.col("n_nationkey") + 1000).alias("key"), "n_name")
    return housing.wages_with_area(_wage_table(t), nations, 60, "key")


@query(_wages("SELECT DISTINCT concat(fips, '0') AS std_cbsa FROM wages"))
def standard_area_codes(t: Tables) -> DataFrame:
    return _wage_table(t).select(housing.standard_area().alias("std_cbsa")).distinct()


@query(_areas("""
SELECT i.geoid, i.name AS name_income, i.year, household_income, r.name AS name_rent, monthly_rent
FROM income i LEFT JOIN rent r ON i.geoid = r.geoid AND i.year = r.year WHERE i.year = 1997"""))
def suffix_join(t: Tables) -> DataFrame:
    pairs = housing.rent_and_income(_measure(t, "household_income"), _measure(t, "monthly_rent"), 1997)
    return pairs.drop("fit", "residual")


@query(_areas("""
SELECT i.geoid, round(line.intercept + line.slope * household_income, 3) AS fit,
       round(monthly_rent - (line.intercept + line.slope * household_income), 3) AS residual
FROM income i JOIN rent r ON i.geoid = r.geoid AND i.year = r.year,
     (SELECT regr_slope(monthly_rent, household_income) AS slope, regr_intercept(monthly_rent, household_income) AS intercept
      FROM income a JOIN rent b ON a.geoid = b.geoid AND a.year = b.year WHERE a.year = 1997) line
WHERE i.year = 1997"""))
def fitted_rows(t: Tables) -> DataFrame:
    pairs = housing.rent_and_income(_measure(t, "household_income"), _measure(t, "monthly_rent"), 1997)
    return rounded(pairs.select("geoid", "fit", "residual"), 3, "fit", "residual")


@query(_areas("SELECT geoid, name, year, monthly_rent AS rent FROM rent"))
def long_measure(t: Tables) -> DataFrame:
    return housing.measure(s.area_measures(t), "monthly_rent", "rent").select("geoid", "name", "year", "rent")


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN year(o_orderdate) <= 1997 THEN 'historical' ELSE 'current' END AS source
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2000 AND year(o_orderdate) <> 1998""")
def year_slices(t: Tables) -> DataFrame:
    """Two groups of year slices, one year excluded, tagged and bound together."""
    wanted = years(1995, 2000, without=[1998])
    tagged = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    parts = [
        tagged.where(F.col("year").isin([y for y in wanted if rule(y)])).withColumn("source", F.lit(label))
        for label, rule in (("historical", lambda y: y <= 1997), ("current", lambda y: y > 1997))
    ]
    return housing.permits(*parts)


@query("""
SELECT o_orderkey AS area, CAST(floor(o_totalprice / 1000) AS INTEGER) AS units FROM orders""")
def fixed_width_slice(t: Tables) -> DataFrame:
    """Orders written as fixed-width lines and cut back into numbers."""
    line = F.concat(
        F.lit("    "), F.rpad(F.col("o_orderkey").cast("string"), 43, " "),
        F.lpad(F.floor(F.col("o_totalprice") / 1000).cast("string"), 6, " "),
    )
    lines = t.orders.select(line.alias("line"))
    return lines.select(
        F.trim(cut(F.col("line"), 5, 20)).try_cast("long").alias("area"),
        text_to_int(cut(F.col("line"), 48, 53)).alias("units"),
    )


@query("""
SELECT CAST(10000 + c_nationkey AS BIGINT) AS cbsa, CAST(count(*) AS INTEGER) AS new_housing_units_permitted,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def permit_listing(t: Tables) -> DataFrame:
    """Yearly counts per nation laid out as a listing with eleven leading lines (codes and
    counts on lines of their own), read by the listing reader."""
    counts = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.year("o_orderdate").alias("y"), (F.col("c_nationkey") + 10000).alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    blank = F.lit(" " * 47)
    entry = F.concat(
        F.lit("123 "), F.col("code").cast("string"), F.lit("  area\n"),
        blank, F.lpad(F.col("n").cast("string"), 6, " "), F.lit("\n"),
    )
    files = (
        counts.select("y", "code", entry.alias("entry")).groupBy("y")
        .agg(F.sort_array(F.collect_list(F.struct("code", "entry"))).alias("entries"))
        .select(
            F.concat(F.lit("/landed/tb3u"), F.col("y").cast("string"), F.lit(".txt")).alias("path"),
            F.concat(
                F.lit("heading 1\n" * 11), F.array_join(F.transform("entries", lambda e: e["entry"]), "")
            ).alias("value"),
        )
    )
    return permit_table(files)


@query("""
SELECT CAST(10000 + c_nationkey AS BIGINT) AS cbsa, CAST(count(*) AS INTEGER) AS new_housing_units_permitted,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 3 GROUP BY ALL""")
def permit_sheet(t: Tables) -> DataFrame:
    """Yearly counts per nation laid out as sheets with five leading lines and quoted names; one nation's
    rows lack a cell and so are left out."""
    counts = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.year("o_orderdate").alias("y"), "c_nationkey", "n_name").agg(F.count(F.lit(1)).alias("n"))
    )
    csa = F.when(F.col("c_nationkey") == 3, F.lit("")).otherwise(F.lit("999"))
    line = F.concat_ws(
        ",", csa, (F.col("c_nationkey") + 10000).cast("string"), F.concat(F.lit('"'), "n_name", F.lit(', ""XY"""')), F.col("n").cast("string")
    )
    files = (
        counts.select("y", line.alias("line")).groupBy("y").agg(F.sort_array(F.collect_list("line")).alias("lines"))
        .select(
            F.concat(F.lit("/landed/msaannual_"), F.col("y").cast("string"), F.lit("99.csv")).alias("path"),
            F.concat(F.lit("Table\n\n\n\n\nCSA,CBSA,Name,Total\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("value"),
        )
    )
    return read_sheet(files)


@query("""
SELECT doc_id, CAST(position AS INTEGER) AS position, long_line, short_line FROM (
  SELECT doc_id, unnest(range(1, greatest(len(longs), len(shorts)) + 1)) AS position,
         unnest(list_transform(range(1, greatest(len(longs), len(shorts)) + 1), lambda i: longs[i])) AS long_line,
         unnest(list_transform(range(1, greatest(len(longs), len(shorts)) + 1), lambda i: shorts[i])) AS short_line
  FROM (SELECT doc_id, list_transform(list_filter(lines, lambda l: length(l) >= 200), lambda l: CAST(length(l) AS INTEGER)) AS longs,
               list_transform(list_filter(lines, lambda l: length(l) < 200), lambda l: CAST(length(l) AS INTEGER)) AS shorts
        FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '\\r?\\n$', ''), '\\r?\\n') AS lines FROM documents)))""")
def positional_zip(t: Tables) -> DataFrame:
    """Lengths of the long and of the short lines of a text, paired by position."""
    texts = t.documents.select("doc_id", lines_of("text").alias("lines"))
    longs = F.transform(F.filter("lines", lambda l: F.length(l) >= 200), F.length)
    shorts = F.transform(F.filter("lines", lambda l: F.length(l) < 200), F.length)
    lists = texts.select("doc_id", longs.alias("longs"), shorts.alias("shorts"))
    return pair_by_position(lists, F.col("longs"), F.col("shorts"), ("long_line", "short_line")).drop("longs", "shorts")


@query("""
SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS n FROM orders GROUP BY 1""")
def week_counts(t: Tables) -> DataFrame:
    """Counts per ISO week start, the label without the year-end clash."""
    return t.orders.groupBy(week_start(F.col("o_orderdate").cast("date")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
