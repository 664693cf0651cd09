"""Housing, income and wages by metropolitan area."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook import schemas
from fieldbook.functions.nulls import if_else, strict_sum
from fieldbook.functions.numbers import ratio, text_to_double, text_to_int
from fieldbook.functions.text import prefix, remove_first, remove_first_text, state_code, trim_space
from fieldbook.operators.joins import equi_join, suffix_join
from fieldbook.operators.literals import literal_table
from fieldbook.operators.ranking import top_n, top_n_per_group, top_n_ranked
from fieldbook.operators.reshape import drop_prefixed, ints_where_named
from fieldbook.operators.sets import bind_same, require_complete
from fieldbook.operators.stats import with_fitted_line
from fieldbook.sources.archives import read_zipped_csv, undersized
from fieldbook.sources.delimited import read_year_folders
from fieldbook.sources.html_tables import html_rows, table_columns
from fieldbook.sources.materialise import keep, read_through

# Two-digit sectors that the published list gives only as ranges.
RANGE_SECTORS = [
    ("31", "Manufacturing", 1),
    ("32", "Manufacturing", 1),
    ("33", "Manufacturing", 1),
    ("44", "Retail", 1),
    ("45", "Retail", 1),
    ("48", "Transportation and Warehousing", 1),
    ("49", "Transportation and Warehousing", 1),
]
ALL_INDUSTRIES = 10


def measure(long_table: DataFrame, variable: str, name: str | None = None) -> DataFrame:
    """One measure of the long statistics table, its value column named after the measure."""
    return (
        long_table.where(F.col("variable") == variable)
        .drop("moe", "variable").withColumnRenamed("estimate", name or variable)
    )


def load_measure(spark: SparkSession, root: str, variable: str, years: Iterable[int], name: str | None = None) -> DataFrame:
    """One measure of the long table stored in year folders; only the wanted years are read."""
    return measure(read_year_folders(spark, root, schemas.AREA_MEASURE, years), variable, name)


def permits(historical: DataFrame, current: DataFrame) -> DataFrame:
    """Fixed-width years and sheet years as one table."""
    return bind_same(historical, current)


def industry_titles(listing: DataFrame, label: str = "NAICS") -> DataFrame:
    """Code, cleaned title and depth (code length - 1) of a published listing with columns
    ``code`` and ``industry_title``; longer codes are left out, range sectors added."""
    title = trim_space(remove_first(remove_first_text("industry_title", "code"), label))
    listed = listing.select(
        "code", title.alias("title"),
        F.when(F.length("code") <= 5, F.length("code") - 1).alias("depth"),
    ).where(F.col("depth").isNotNull())
    ranges = literal_table(listing.sparkSession, RANGE_SECTORS, "code:string, title:string, depth:int")
    return bind_same(listed, ranges)


def industry_listing(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                     table_id: str = "naics_titles") -> DataFrame:
    """Code and title columns of the published list, taken from a page by its table id."""
    rows = html_rows(pages, page_id, html)
    return table_columns(rows, F.col("table_id") == table_id, [], ["code", "industry_title"])


def industry_hierarchy(titles: DataFrame, lengths: tuple[int, int, int] = (2, 3, 4), depth: int = 4) -> DataFrame:
    """Each lowest-level code with the codes and titles of the three levels above it."""
    tree = titles.where(F.col("depth") == depth).withColumnsRenamed({"title": "level4_title", "code": "level4_code"})
    for level, length in enumerate(lengths, 1):
        tree = tree.withColumn(f"level{level}_code", prefix("level4_code", length))
    for level in (1, 2, 3):
        parents = titles.select("code", F.col("title").alias(f"level{level}_title"),
                                F.col("depth").alias(f"depth{level}"))
        tree = equi_join(tree, parents, [(f"level{level}_code", "code")], "left", null_safe=False)
    levels = (1, 2, 3, 4)
    chosen = drop_prefixed(tree, "depth").select(
        *[f"level{i}_title" for i in levels], *[f"level{i}_code" for i in levels]
    )
    return ints_where_named(chosen.na.drop("any"), "code")


def read_wages(spark: SparkSession, paths: str | list[str], years: Iterable[int], least_bytes: int = 1) -> DataFrame:
    """Wage table from yearly zip archives.

    An error names archives that are broken or smaller than ``least_bytes`` (published ones have
    75 MB and more) and the wanted years without rows, so that no year is lost unseen. The archives are read
    once: their rows and faults are written to the shared folder together.
    """
    columns = ["area_fips", "industry_code", "annual_avg_emplvl", "total_annual_wages"]
    raw = keep(read_zipped_csv(spark, paths, columns, fault="fault"))
    faults = [f"{r.path}: {r.fault}" for r in raw.where("fault is not null").select("path", "fault").collect()]
    faults += [f"{r.path}: only {r.length} bytes" for r in undersized(spark, paths, least_bytes).collect()]
    if faults:
        raise ValueError(f"unusable archives: {sorted(faults)}")
    year = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"(\d{4})", 1).try_cast("int")
    return require_complete(clean_wages(raw.withColumn("year", year).drop("path", "fault")), "year", years)


def wages_once(spark: SparkSession, landed: str, paths: str | list[str], years: Iterable[int], least_bytes: int = 1) -> DataFrame:
    """The wage table, read from the archives where these have changed and else from Parquet at ``landed``."""
    return read_through(spark, landed, lambda: read_wages(spark, paths, years, least_bytes), paths)


def clean_wages(raw: DataFrame) -> DataFrame:
    """Metropolitan areas and plain industry codes only, typed, with the average wage."""
    code = F.col("industry_code")
    kept = raw.where(
        (F.length(code) <= 5) & F.col("area_fips").startswith("C") & ~code.contains("-")
    ).select(
        "year", F.col("area_fips").alias("fips"), text_to_int(code).alias("industry"),
        text_to_int("annual_avg_emplvl").alias("employment"),
        text_to_double("total_annual_wages").alias("total_wages"),
    )
    return kept.where(F.col("industry") != ALL_INDUSTRIES).withColumn("avg_wage", ratio("total_wages", "employment"))


def fips_key(fips: str | Column = "fips") -> Column:
    """Area number of an area code: its first non-digit removed, as a number."""
    return remove_first(fips, "[^0-9]").try_cast("double")


def standard_area(fips: str = "fips") -> Column:
    return F.concat(F.col(fips), F.lit("0"))


def most_permits(permit_table: DataFrame, population: DataFrame, first: int, last: int, n: int = 1) -> DataFrame:
    """Areas with the most units permitted in a range of years."""
    rows = permit_table.where(F.col("year").between(first, last))
    joined = equi_join(rows, population, [("cbsa", "geoid"), ("year", "year")])
    totals = joined.groupBy("name").agg(strict_sum("new_housing_units_permitted").alias("decade_totals"))
    return top_n_ranked(totals, "decade_totals", n)


def _area_permits(permit_table: DataFrame, population: DataFrame, area: str) -> DataFrame:
    rows = permit_table.where(F.col("cbsa").cast("string") == area)
    return equi_join(rows, population, [("cbsa", "geoid"), ("year", "year")])


def permit_rate(permit_table: DataFrame, population: DataFrame, area: str, years: Iterable[int]) -> DataFrame:
    """Mean permits per head of one area over chosen years."""
    rows = _area_permits(permit_table, population, area).where(F.col("year").isin(list(years)))
    return rows.agg(F.avg(ratio("new_housing_units_permitted", "population")).alias("adjustment"))


def peak_permit_year(permit_table: DataFrame, population: DataFrame, area: str,
                     fix_year: int, fix_value: int) -> DataFrame:
    """Year with the most permits of one area after correcting a single year."""
    rows = _area_permits(permit_table, population, area)
    fixed = if_else(F.col("year") == fix_year, F.lit(fix_value), F.col("new_housing_units_permitted"))
    return top_n(rows.withColumn("new_housing_units_permitted", fixed), "new_housing_units_permitted")


def state_income(income: DataFrame, households: DataFrame, population: DataFrame, year: int,
                 n: int = 1) -> DataFrame:
    """States with the highest income per head. One unknown area makes its state unknown."""
    keys = ["geoid", "name", "year"]
    areas = income.where(F.col("year") == year)
    areas = equi_join(areas, households, keys, "left")
    areas = equi_join(areas, population, keys, "left")
    areas = areas.withColumns({
        "total_income": F.col("household_income") * F.col("households"),
        "state": state_code("name"),
    })
    states = areas.groupBy("state").agg(
        strict_sum("population").alias("total_population"),
        strict_sum("total_income").alias("total_income"),
    )
    return top_n_ranked(states.withColumn("individual_income", ratio("total_income", "total_population")),
                        "individual_income", n)


def last_year_leading(wages: DataFrame, fips: str, industry: int) -> DataFrame:
    """Last year in which one area had the most employment of an industry."""
    rows = wages.where(F.col("industry") == industry).select("year", "fips", "employment")
    leaders = top_n_per_group(rows, ["year"], "employment").where(F.col("fips") == fips)
    return leaders.orderBy(F.desc_nulls_last("year"), "fips").limit(1)


def sector_share_peak(wages: DataFrame, fips: str, industry: int) -> DataFrame:
    """Year in which an industry's share of an area's wages peaked."""
    rows = wages.where(F.col("fips") == fips)
    shares = rows.groupBy("year").agg(
        F.sum(F.when(F.col("industry") == industry, F.col("total_wages"))).alias("sector_wages"),
        F.sum("total_wages").alias("all_wages"),
    ).withColumn("wage_share", ratio("sector_wages", "all_wages"))
    return top_n_ranked(shares, "wage_share")


def wages_with_area(wages: DataFrame, areas: DataFrame, industry: int, key: str) -> DataFrame:
    """Wage rows of an industry joined with an area table on the number in the area code."""
    rows = wages.where(F.col("industry") == industry).withColumn("link", fips_key())
    rows = rows.where(F.col("link").isNotNull())
    areas = areas.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("double"))
    return equi_join(rows.select("year", "employment", "link"), areas, [("link", key)], null_safe=False)


def rent_and_income(income: DataFrame, rent: DataFrame, year: int) -> DataFrame:
    """Income and rent of each area in a year with the fitted line of rent on income."""
    pairs = suffix_join(
        income.where(F.col("year") == year), rent, ["geoid", "year"], ("_income", "_rent")
    )
    return with_fitted_line(pairs, "monthly_rent", "household_income")
