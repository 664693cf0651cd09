"""Points in polygons and nearest points.

A predicate join alone would compare every point with every polygon. Both sides get a grid
cell instead: a point lies in one cell, a polygon is listed in each cell its box meets, so
the join is an equi-join on the cell and the exact test runs on the few candidates. Each
cell keeps only the edges that can matter for points in it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions.geometry import EARTH_RADIUS_M, EDGES_TYPE, great_circle_m, in_polygon
from fieldbook.operators.ranking import bottom_n

# One side length of a cell, or its width and height.
CellSize = float | tuple[float, float]


def _sides(size: CellSize) -> tuple[float, float]:
    width, height = size if isinstance(size, tuple) else (size, size)
    return float(width), float(height)


def _cell(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(side))


def polygon_cells(polygons: DataFrame, size: CellSize, edges: str = "edges") -> DataFrame:
    """One row per polygon and grid cell (``__cx``, ``__cy``) that the polygon may share.

    Cells without an edge are wholly inside (``__whole``, no edges kept) or outside (left out).
    The others keep the edges that a point in the cell can need.

    A ray to the right can meet only edges of its own height that end right of the cell's left side. So
    each edge is sent to the cells of its rows, from the polygon's left end to the edge's right
    end, and the edges of a cell meet there: the work is spread by edge and by cell, and no task
    holds a polygon's whole grid. Every cell inside has an edge to its right, so none is missed.
    """
    es = F.col(edges)
    width, height = _sides(size)
    # A little slack absorbs rounding in the division that assigns cells.
    slack_x, slack_y = width * 1e-6, height * 1e-6
    least_x = F.array_min(F.transform(es, lambda e: F.least(e["x1"], e["x2"])))
    others = [c for c in polygons.columns if c != edges]
    sent = (
        polygons.select(
            F.monotonically_increasing_id().alias("__polygon"), F.struct(F.lit(0).alias("__zero"), *others).alias("__others"),
            _cell(least_x - slack_x, width).alias("__first"), es.alias("__edges"),
        )
        .select("__polygon", "__others", "__first", F.explode("__edges").alias("__edge"))
        .withColumn("__cy", F.explode(F.sequence(
            _cell(F.least("__edge.y1", "__edge.y2") - slack_y, height), _cell(F.greatest("__edge.y1", "__edge.y2") + slack_y, height)
        )))
        .withColumn("__cx", F.explode(F.sequence("__first", _cell(F.greatest("__edge.x1", "__edge.x2") + slack_x, width))))
    )
    cells = (
        sent.groupBy("__polygon", "__cx", "__cy").agg(F.first("__others").alias("__others"), F.collect_list("__edge").alias(edges))
        .select(*[F.col("__others")[c].alias(c) for c in others], "__cx", "__cy", edges)
    )
    left, bottom = F.col("__cx") * F.lit(width), F.col("__cy") * F.lit(height)
    right, top = left + F.lit(width), bottom + F.lit(height)
    cut = F.exists(edges, lambda e: F.least(e["x1"], e["x2"]) <= right + slack_x)
    middle = in_polygon((left + right) / 2, (bottom + top) / 2, edges)
    return (
        cells.withColumn("__whole", ~cut & middle)
        .where(F.col("__whole") | cut)
        .withColumn(edges, F.when(~F.col("__whole"), F.col(edges)).otherwise(F.array().cast(EDGES_TYPE)))
    )


def join_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str, size: CellSize,
                  edges: str = "edges", how: str = "left") -> DataFrame:
    """Attach the polygons a point lies in; unmatched points stay with NULLs.

    Boundary points belong to every polygon they touch. ``how`` may be ``left``, ``inner`` or
    ``left_semi``. AQE measures the cell table and broadcasts it or splits crowded cells.
    """
    cells = polygon_cells(polygons, size, edges).withColumnRenamed(edges, "__edges")
    width, height = _sides(size)
    located = points.withColumns({"__px": _cell(F.col(x), width), "__py": _cell(F.col(y), height)})
    condition = (
        (F.col("__px") == F.col("__cx"))
        & (F.col("__py") == F.col("__cy"))
        & (F.col("__whole") | in_polygon(x, y, "__edges"))
    )
    return located.join(cells, condition, how).drop("__px", "__py", "__cx", "__cy", "__edges", "__whole")


def points_within(points: DataFrame, polygons: DataFrame, x: str, y: str, size: CellSize,
                  edges: str = "edges") -> DataFrame:
    """Points inside at least one polygon, each once."""
    return join_polygons(points, polygons, x, y, size, edges, "left_semi")


def near_box(lon: Column, lat: Column, to_lon: float, to_lat: float, metres: float) -> Column:
    """Plain comparisons that all points within so many metres of a place pass.

    Coordinates outside their usual ranges pass too, as they may name a near place in another way.
    """
    reach = math.degrees(metres / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    low, high = to_lat - reach, to_lat + reach
    inside, beyond = lat.between(low, high), (lat < -90) | (lat > 90)
    if low <= -90 or high >= 90:
        return inside | beyond
    at = (to_lon + 180) % 360 - 180
    # The widest meridians that a circle around the place touches.
    aside = math.degrees(math.asin(math.sin(math.radians(reach)) / math.cos(math.radians(to_lat)))) * (1 + 1e-9) + 1e-9
    turns = [lon.between(at + turn - aside, at + turn + aside) for turn in (-360, 0, 360)]
    return (inside & (reduce(or_, turns) | (lon < -180) | (lon > 360))) | beyond


def nearest(points: DataFrame, lon: str, lat: str, to_lon: float, to_lat: float, n: int,
            distance: str = "distance", sample: int = 1000) -> DataFrame:
    """The n nearest points to a fixed place, ties kept.

    Any n points bound the n-th distance. They come from the first ``sample`` located ones, and a box that holds
    the bound is compared with the bare coordinates, so it reaches the scan, or the points' side of a join, before any
    distance is computed. A poor sample gives a large box, never a wrong result.
    """
    away = great_circle_m(lon, lat, to_lon, to_lat)
    some = points.select(away.alias("m")).where(F.col("m").isNotNull() & ~F.isnan("m")).limit(max(sample, n)).collect()
    if n and len(some) >= n:
        points = points.where(near_box(F.col(lon), F.col(lat), to_lon, to_lat, sorted(r.m for r in some)[n - 1]))
    return bottom_n(points.withColumn(distance, away), distance, n)


def without_geometry(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
