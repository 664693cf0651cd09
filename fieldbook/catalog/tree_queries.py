"""Tree analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog import standins as s
from fieldbook.catalog.registry import Tables, query, rounded, with_views
from fieldbook.functions.geometry import EDGES_TYPE, great_circle_m, in_polygon, ring_edges
from fieldbook.operators.ranking import bottom_n
from fieldbook.operators.spatial import join_polygons
from fieldbook.plans import trees
from fieldbook.sources.geojson import as_points, features_in


def _trees(sql: str) -> str:
    return with_views(sql, **s.TREE_VIEWS)


def _located(t: Tables) -> DataFrame:
    return trees.with_district(s.trees(t), s.districts(t), s.DISTRICT_CELL)


@query("""
SELECT c_custkey AS id, c_mktsegment AS name, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_nationkey AS DOUBLE) / 2 AS lat
FROM customer""")
def paged_features(t: Tables) -> DataFrame:
    """Points of GeoJSON pages, one page per nation, read as one table."""
    place = F.array((F.col("c_custkey") % 360 - 180).cast("double"), F.col("c_nationkey").cast("double") / 2)
    feature = F.struct(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), place.alias("coordinates")).alias("geometry"),
    )
    # A page holds 500 features, as the service sends them.
    pages = t.customer.groupBy("c_nationkey", F.floor(F.col("c_custkey") / 500)).agg(F.collect_list(feature).alias("features"))
    texts = pages.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))
    return as_points(features_in(texts, "value", "id: bigint, name: string"))


@query(_trees("SELECT vec_id, genusspecies, tpcondition, lon, lat, district, area FROM located"))
def points_in_polygons(t: Tables) -> DataFrame:
    return _located(t).select("vec_id", "genusspecies", "tpcondition", "lon", "lat", "district", "area")


@query(_trees("""
SELECT district, count(*) AS count FROM located GROUP BY district QUALIFY rank() OVER (ORDER BY count(*) DESC) <= 5"""))
def points_per_polygon(t: Tables) -> DataFrame:
    return trees.per_district(_located(t))


@query(_trees("""
SELECT district, area, count(*) AS count, count(*) / area AS density FROM located GROUP BY district, area
QUALIFY rank() OVER (ORDER BY count(*) / area DESC NULLS LAST) <= 4"""))
def density(t: Tables) -> DataFrame:
    return trees.density(_located(t), 4)


@query(_trees("""
SELECT district, count(*) AS count, count(*) FILTER (tpcondition = 'Dead') AS dead_trees,
       count(*) FILTER (tpcondition = 'Dead') / count(*) AS fraction_dead_trees
FROM located GROUP BY district QUALIFY rank() OVER (ORDER BY count(*) FILTER (tpcondition = 'Dead') / count(*) DESC) <= 3"""))
def count_if_ratio(t: Tables) -> DataFrame:
    return trees.dead_fraction(_located(t), 3)


@query(_trees("""
SELECT CASE WHEN district BETWEEN 1 AND 10 THEN 'Manhattan' WHEN district BETWEEN 11 AND 18 THEN 'Bronx'
            WHEN district BETWEEN 19 AND 32 THEN 'Queens' WHEN district BETWEEN 33 AND 48 THEN 'Brooklyn'
            WHEN district BETWEEN 49 AND 51 THEN 'Staten Island' ELSE 'Other' END AS borough, count(*) AS count
FROM located GROUP BY 1"""))
def range_label(t: Tables) -> DataFrame:
    return trees.with_borough(_located(t)).groupBy("borough").agg(F.count(F.lit(1)).alias("count"))


@query(_trees("""
SELECT genusspecies, count(*) AS count FROM located WHERE district BETWEEN 1 AND 10 GROUP BY genusspecies"""))
def species_in_borough(t: Tables) -> DataFrame:
    return trees.species_in(_located(t), "Manhattan")


@query(_trees("""
SELECT genusspecies, district, round(distance, 3) AS distance FROM (
  SELECT genusspecies, district,
         2 * 6371010.0 * asin(sqrt(least(1.0, pow(sin((radians(lat) - radians(0.05)) / 2), 2)
           + cos(radians(0.05)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(0.02)) / 2), 2)))) AS distance
  FROM located)
QUALIFY rank() OVER (ORDER BY distance) <= 5"""))
def nearest_points(t: Tables) -> DataFrame:
    return rounded(trees.closest(_located(t), 0.02, 0.05, 5), 3, "distance")


@query(_trees("""
SELECT tpcondition, count(*) AS tree_count FROM located WHERE district = 26 GROUP BY tpcondition"""))
def conditions_in_polygon(t: Tables) -> DataFrame:
    return trees.conditions_in(_located(t), 26)


@query(_trees("""
SELECT vec_id, tpcondition, coalesce(tpcondition IN ('Poor', 'Critical', 'Dead'), FALSE) AS unhealthy
FROM trees WHERE vec_id IN (SELECT vec_id FROM inside WHERE district = 26)"""))
def points_semi(t: Tables) -> DataFrame:
    healthy, unhealthy = trees.split_by_health(s.trees(t), s.districts(t), 26, s.DISTRICT_CELL)
    both = healthy.withColumn("unhealthy", F.lit(False)).unionByName(unhealthy.withColumn("unhealthy", F.lit(True)))
    return both.select("vec_id", "tpcondition", "unhealthy")


@query(with_views("""
SELECT vec_id, round(metres, 2) AS metres, inside FROM (
  SELECT vec_id, lon BETWEEN -9 AND 4.5 AND lat BETWEEN -4.5 AND 9 AS inside,
         2 * 6371010.0 * asin(sqrt(least(1.0, pow(sin((radians(lat) - radians(1.5)) / 2), 2)
           + cos(radians(1.5)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(-2.25)) / 2), 2)))) AS metres
  FROM (SELECT vec_id, 90 * lon AS lon, 90 * lat AS lat FROM trees))""", trees=s.TREES))
def great_circle(t: Tables) -> DataFrame:
    """Distance of every point to a fixed place and whether it lies in a fixed square."""
    square = ring_edges([(-9, -4.5), (4.5, -4.5), (4.5, 9), (-9, 9)])
    edges = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(e, ("x1", "y1", "x2", "y2"))]) for e in square])
    points = s.trees(t).select("vec_id", (F.col("lon") * 90).alias("lon"), (F.col("lat") * 90).alias("lat"))
    return rounded(points.select(
        "vec_id", great_circle_m("lon", "lat", -2.25, 1.5).alias("metres"),
        in_polygon("lon", "lat", edges.cast(EDGES_TYPE)).alias("inside"),
    ), 2, "metres")


# Corner points of plain integers, so that many points lie exactly on an edge.
_FIELD_RINGS = [
    (1, [(1, 10000), (20, 10000), (20, 60000), (1, 60000)]),
    (2, [(20, 10000), (40, 10000), (40, 30000), (30, 30000), (30, 60000), (20, 60000)]),
]


def _field_edges() -> str:
    return ", ".join(
        f"({n}, CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE), CAST({c!r} AS DOUBLE), CAST({d!r} AS DOUBLE))"
        for n, ring in _FIELD_RINGS for a, b, c, d in ring_edges(ring)
    )


@query(f"""
SELECT field, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM (
  SELECT l_linenumber, unnest(CASE WHEN one AND two THEN [1, 2] WHEN one THEN [1] WHEN two THEN [2] ELSE [NULL] END) AS field
  FROM (SELECT l_linenumber,
               l_quantity BETWEEN 1 AND 20 AND l_extendedprice BETWEEN 10000 AND 60000 AS one,
               l_extendedprice BETWEEN 10000 AND 60000 AND l_quantity BETWEEN 20 AND 40
                 AND (l_quantity <= 30 OR l_extendedprice <= 30000) AS two FROM lineitem))
GROUP BY field""")
def points_on_edges(t: Tables) -> DataFrame:
    """Line items as points of quantity and price: boundary points belong to each polygon."""
    fields = t.spark.createDataFrame([(n, ring_edges(ring)) for n, ring in _FIELD_RINGS], f"field int, edges {EDGES_TYPE}")
    points = t.lineitem.select("l_linenumber", "l_quantity", (F.col("l_extendedprice")).alias("price"))
    located = join_polygons(points, fields, "l_quantity", "price", (1.0, 5000.0))
    return located.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query("""
SELECT c_custkey, c_acctbal FROM customer QUALIFY rank() OVER (ORDER BY c_acctbal) <= 5""")
def global_bottom_ties(t: Tables) -> DataFrame:
    return bottom_n(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 5)
