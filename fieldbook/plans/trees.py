"""Tree points by council district."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldbook.functions.nulls import not_in
from fieldbook.functions.numbers import ratio
from fieldbook.operators.ranking import top_n
from fieldbook.operators.reshape import bin_label
from fieldbook.operators.spatial import join_polygons, nearest, points_within, without_geometry
from fieldbook.sources.geojson import as_points, as_polygons, read_features

# District ranges of the boroughs.
BOROUGHS = [
    (1, 10, "Manhattan"),
    (11, 18, "Bronx"),
    (19, 32, "Queens"),
    (33, 48, "Brooklyn"),
    (49, 51, "Staten Island"),
]
# Conditions that need work.
UNHEALTHY = ["Poor", "Critical", "Dead"]
# About one kilometre in degrees.
CELL_DEGREES = 0.01


def read_trees(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All landed pages of the tree service as one table."""
    return as_points(read_features(spark, paths, "tpcondition: string, genusspecies: string"))


def read_districts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return as_polygons(read_features(spark, paths, "district: int, area: double"))


def with_district(trees: DataFrame, districts: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """Every tree with its district; trees outside all districts keep NULL."""
    return join_polygons(trees, districts, "lon", "lat", cell)


def _plain(located: DataFrame) -> DataFrame:
    return without_geometry(located, ["lon", "lat"])


def per_district(located: DataFrame, n: int = 5) -> DataFrame:
    counts = _plain(located).groupBy("district").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts, "count", n)


def density(located: DataFrame, n: int = 10) -> DataFrame:
    counts = _plain(located).groupBy("district", "area").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts.withColumn("density", ratio("count", "area")), "density", n)


def dead_fraction(located: DataFrame, n: int = 10) -> DataFrame:
    counts = _plain(located).groupBy("district").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("tpcondition") == "Dead").alias("dead_trees"),
    )
    return top_n(counts.withColumn("fraction_dead_trees", ratio("dead_trees", "count")), "fraction_dead_trees", n)


def with_borough(located: DataFrame) -> DataFrame:
    return located.withColumn("borough", bin_label("district", BOROUGHS, "Other"))


def species_in(located: DataFrame, borough: str) -> DataFrame:
    """Species of a borough, most common first."""
    rows = _plain(with_borough(located)).where(F.col("borough") == borough)
    return (
        rows.groupBy("genusspecies").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "genusspecies")
    )


def closest(located: DataFrame, lon: float, lat: float, n: int = 5) -> DataFrame:
    return nearest(located, "lon", "lat", lon, lat, n).select("genusspecies", "district", "distance")


def conditions_in(located: DataFrame, district: int) -> DataFrame:
    rows = _plain(located).where(F.col("district") == district)
    return rows.groupBy("tpcondition").agg(F.count(F.lit(1)).alias("tree_count"))


def split_by_health(trees: DataFrame, districts: DataFrame, district: int, cell: float = CELL_DEGREES,
                    unhealthy: Sequence[str] = UNHEALTHY) -> tuple[DataFrame, DataFrame]:
    """Healthy (unknown conditions included) and unhealthy trees inside one district."""
    inside = points_within(trees, districts.where(F.col("district") == district), "lon", "lat", cell)
    return (
        inside.where(not_in("tpcondition", unhealthy)),
        inside.where(F.col("tpcondition").isin(list(unhealthy))),
    )
