"""GeoJSON feature collections: points and polygons, from one page or many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook.functions.geometry import EDGES_TYPE

_NUMBERS = "array<double>"
_POLYGON = f"array<array<{_NUMBERS}>>"
_MULTI = f"array<{_POLYGON}>"


def read_features(spark: SparkSession, paths: str | list[str], properties: str) -> DataFrame:
    """One row per feature of all pages: the given properties plus ``kind`` and ``coordinates``.

    Coordinates stay JSON text, as their nesting depends on the kind of geometry.
    """
    return _features(spark.read.schema(_collection(properties)).json(paths, multiLine=True))


def features_in(pages: DataFrame, text: str, properties: str) -> DataFrame:
    """The same of pages whose texts are a column."""
    return _features(pages.select(F.from_json(text, _collection(properties)).alias("page")).select("page.features"))


def _collection(properties: str) -> str:
    return f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"


def _features(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("features").alias("f")).select(
        "f.properties.*",
        F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def as_points(features: DataFrame) -> DataFrame:
    place = F.from_json("coordinates", _NUMBERS)
    return (
        features.where(F.col("kind") == "Point")
        .withColumns({"lon": place[0], "lat": place[1]}).drop("kind", "coordinates")
    )


def _ring_to_edges(ring: Column) -> Column:
    ends = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))
    return F.transform(ends, lambda e: F.struct(
        e["a"][0].alias("x1"), e["a"][1].alias("y1"), e["b"][0].alias("x2"), e["b"][1].alias("y2")
    ))


def as_polygons(features: DataFrame, edges: str = "edges") -> DataFrame:
    """Polygons and multipolygons with all rings, holes included, as one edge array."""
    rings = F.when(F.col("kind") == "Polygon", F.from_json("coordinates", _POLYGON)).when(
        F.col("kind") == "MultiPolygon", F.flatten(F.from_json("coordinates", _MULTI))
    )
    return (
        features.where(F.col("kind").isin("Polygon", "MultiPolygon"))
        .withColumn(edges, F.flatten(F.transform(rings, _ring_to_edges)).cast(EDGES_TYPE))
        .drop("kind", "coordinates")
    )
