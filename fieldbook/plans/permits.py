"""Film permits: three files with drifting schemas made one table, and its analyses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook import schemas
from fieldbook.functions.dates import between_midnights, parse_mdy_hms
from fieldbook.functions.nulls import n_distinct, not_in
from fieldbook.functions.numbers import round_even
from fieldbook.functions.text import trim_space
from fieldbook.operators.groups import with_group_sizes
from fieldbook.operators.joins import lookup, natural_full_join
from fieldbook.operators.periods import mean_growth, overlap_with_previous, yearly
from fieldbook.operators.quantiles import with_quantile_bin
from fieldbook.operators.ranking import first_per_key, top_n_per_group, with_position
from fieldbook.operators.reshape import lower_names, relocate, split_to_rows
from fieldbook.operators.stats import ols_line
from fieldbook.sources.delimited import read_csv, read_csv_tidy

# Names of ten zip codes.
ZIP_NAMES = {
    "11222": "Greenpoint, Brooklyn",
    "11101": "Long Island City, Queens",
    "10036": "Hell's Kitchen, Manhattan",
    "10011": "Chelsea, Manhattan",
    "10013": "Chinatown, Manhattan",
    "10019": "Midtown West, Manhattan",
    "11201": "Brooklyn Heights, Brooklyn",
    "10003": "East Village, Manhattan",
    "10012": "SoHo, Manhattan",
    "10001": "Hudson Yards, Manhattan",
}
# Years with missing months or a closed industry.
ODD_YEARS = [2020, 2023]

_LISTS = {"communityboard_s": "communityboards", "policeprecinct_s": "policeprecincts", "zipcode_s": "zipcodes"}
_PARTS = ["start_year", "start_month", "start_day", "end_year", "end_month", "end_day"]


def read_newest(spark: SparkSession, path: str, warn: bool = False) -> DataFrame:
    return read_csv_tidy(spark, path, schemas.PERMITS_NEWEST, extra=True, warn=warn)


def read_mid(spark: SparkSession, path: str, warn: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.PERMITS_MID, extra=True, warn=warn)


def read_oldest(spark: SparkSession, path: str, warn: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.PERMITS_OLDEST, extra=True, warn=warn)


def harmonise_newest(newest: DataFrame) -> DataFrame:
    """Lower-case names, list columns renamed, month-first texts to times."""
    named = lower_names(newest).withColumnsRenamed(_LISTS)
    return named.withColumns({c: parse_mdy_hms(c) for c in ("startdatetime", "enddatetime", "enteredon")})


def harmonise_oldest(oldest: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """First row of each event in the given order, without its location columns."""
    rows = first_per_key(oldest, ["eventid"], order)
    return rows.drop("main", "cross_st_1", "cross_st_2").withColumnsRenamed(_LISTS)


def clean_permits(newest: DataFrame, mid: DataFrame, oldest: DataFrame, oldest_order: Sequence[str | Column],
                  first: str = "2013-01-01", last: str = "2023-12-31",
                  event_type: str = "Shooting Permit") -> DataFrame:
    """One row per permit and zip code with the zip code's group sizes.

    Time range and event type are join keys of both natural joins, so they are filtered
    before the joins instead of after them. The plan is lazy and writes nothing; each file is read once.
    """
    def wanted(df: DataFrame) -> DataFrame:
        return df.where(between_midnights("startdatetime", first, last) & (F.col("eventtype") == event_type))

    # A file lists a permit once, so no event is hot and one full outer join does.
    recent = natural_full_join(wanted(harmonise_newest(newest)), wanted(mid.withColumnsRenamed(_LISTS)), spread=True)
    # The first row of an event is chosen among all its rows, hence before the filter.
    early = wanted(harmonise_oldest(oldest, oldest_order))
    combined = natural_full_join(recent.drop("parkingheld"), early, spread=True)
    rows = split_to_rows(combined, "zipcodes").withColumns({
        "zipcode": trim_space("zipcodes"),
        "start_year": F.year("startdatetime"),
        "start_month": F.month("startdatetime"),
        "start_day": F.dayofmonth("startdatetime"),
        "end_year": F.year("enddatetime"),
        "end_month": F.month("enddatetime"),
        "end_day": F.dayofmonth("enddatetime"),
    }).drop("communityboards", "policeprecincts", "country", "zipcodes", "enteredon", "startdatetime", "enddatetime")
    return with_zip_counts(relocate(rows, "eventid", "eventtype", *_PARTS))


def with_zip_counts(rows: DataFrame) -> DataFrame:
    keys = ["zipcode", "start_year", "start_month"]
    return with_group_sizes(rows, keys, {
        "zip_count_by_year": keys[:2],
        "zip_count_by_month": keys,
        "zip_count_total": keys[:1],
    }, once=True)


def per_year(permits: DataFrame) -> DataFrame:
    return yearly(permits, "start_year", [], "total_permits").orderBy(F.asc_nulls_last("start_year"))


def per_borough(permits: DataFrame) -> DataFrame:
    counts = permits.groupBy("borough").agg(F.count(F.lit(1)).alias("total_permits"))
    return counts.orderBy(F.desc_nulls_last("total_permits"), "borough")


def decile_concentration(totals: DataFrame, value: str, name: str = "total_productions",
                         units: str = "num_zip_codes", bins: int = 10) -> DataFrame:
    """Totals per quantile bin of a per-unit total; ties at an edge go to the lower bin."""
    binned = with_quantile_bin(totals, value, bins, "Decile", "category")
    return binned.groupBy("category_number", "category").agg(
        F.sum(value).alias(name), F.count(F.lit(1)).alias(units)
    )


def zip_deciles(permits: DataFrame, bins: int = 10) -> DataFrame:
    totals = permits.groupBy("zipcode").agg(F.count(F.lit(1)).alias("productions"))
    return decile_concentration(totals, "productions", bins=bins)


def top_per_year(counts: DataFrame, year: str, item: str, value: str, n: int = 10) -> DataFrame:
    """Top items of each year, ties kept, with their running position."""
    top = top_n_per_group(counts, [year], value, n)
    return with_position(top, [year], value, item, "rank")


def hotspots(permits: DataFrame, n: int = 10) -> DataFrame:
    return top_per_year(yearly(permits, "start_year", ["zipcode"], "productions"),
                        "start_year", "zipcode", "productions", n)


def hotspot_overlap(permits: DataFrame, n: int = 10) -> DataFrame:
    counts = yearly(permits, "start_year", ["zipcode"], "productions")
    return overlap_with_previous(top_n_per_group(counts, ["start_year"], "productions", n), "start_year", "zipcode", n)


def named_hotspots(permits: DataFrame, names: Mapping[str, str] = ZIP_NAMES,
                   without: Iterable[int] = ODD_YEARS) -> DataFrame:
    """Yearly counts of the named zip codes."""
    rows = permits.where(not_in("start_year", without)).where(F.col("zipcode").isin(list(names)))
    return lookup(yearly(rows, "start_year", ["zipcode"], "productions"), "zipcode", names, "neighborhood")


def yearly_pair(permits: DataFrame, first: Column, second: Column, names: tuple[str, str],
                without: Iterable[int] = ODD_YEARS) -> DataFrame:
    """Yearly counts of two conditions, years in which both occur.

    One aggregate instead of two filtered scans and a join.
    """
    rows = permits.where(not_in("start_year", without)).where(first | second)
    counts = rows.groupBy("start_year").agg(
        F.count_if(first).alias(names[0]), F.count_if(second).alias(names[1])
    )
    return counts.where((F.col(names[0]) > 0) & (F.col(names[1]) > 0))


def zip_against_borough(permits: DataFrame, zipcode: str = "11222", borough: str = "Manhattan",
                        without: Iterable[int] = ODD_YEARS) -> DataFrame:
    """Correlation and regression of a zip code's yearly counts on a borough's."""
    pair = yearly_pair(permits, F.col("zipcode") == zipcode, F.col("borough") == borough,
                       ("zip_count", "borough_count"), without)
    return ols_line(pair, "zip_count", "borough_count").select(
        "n", round_even("correlation", 3).alias("correlation"),
        round_even("r_squared", 3).alias("r_squared"), round_even("p_value", 4).alias("p_value"),
    )


def zip_growth(permits: DataFrame) -> DataFrame:
    """Average yearly growth of each zip code."""
    counts = yearly(permits, "start_year", ["zipcode"], "productions")
    return mean_growth(counts, "zipcode", "start_year", "productions")


def distinct_zipcodes(permits: DataFrame) -> DataFrame:
    return permits.agg(n_distinct("zipcode").alias("zipcodes"))
