"""Plane and sphere geometry as expressions.

A polygon is an array of edges ``struct<x1,y1,x2,y2>``; all rings of a polygon with holes
or of several parts sit in one array (even-odd rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from fieldbook.functions.nulls import as_col

EDGES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
EARTH_RADIUS_M = 6371010.0


def ring_edges(points: Sequence[Sequence[float]]) -> list[tuple[float, float, float, float]]:
    """Edges of one closed ring given as literal corner points."""
    closed = list(points) if tuple(points[0]) == tuple(points[-1]) else [*points, points[0]]
    return [
        (float(a[0]), float(a[1]), float(b[0]), float(b[1]))
        for a, b in zip(closed, closed[1:])
    ]


def _crosses(x: Column, y: Column, e: Column) -> Column:
    meet = e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < meet)


def _beside(y: Column, e: Column) -> Column:
    """Above or below the whole edge, which then neither crosses nor touches."""
    return (y < F.least(e["y1"], e["y2"])) | (y > F.greatest(e["y1"], e["y2"]))


def _touches(x: Column, y: Column, e: Column) -> Column:
    turn = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (turn == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))


def in_polygon(x: str | Column, y: str | Column, edges: str | Column) -> Column:
    """Inside or on the boundary.

    One pass over the edges: the low bit counts crossings modulo 2, the next bit is set by a touch.
    """
    px, py = as_col(x), as_col(y)
    state = F.aggregate(
        as_col(edges),
        F.lit(0),
        lambda n, e: (
            F.when(_beside(py, e), n)
            .when(_touches(px, py, e), n.bitwiseOR(2))
            .when(_crosses(px, py, e), n.bitwiseXOR(1))
            .otherwise(n)
        ),
    )
    return state > 0


def great_circle_m(lon: str | Column, lat: str | Column, to_lon: float, to_lat: float) -> Column:
    """Haversine distance in metres to a fixed point."""
    lam, phi = F.radians(as_col(lon)), F.radians(as_col(lat))
    lam0, phi0 = F.radians(F.lit(float(to_lon))), F.radians(F.lit(float(to_lat)))
    h = F.pow(F.sin((phi - phi0) / 2), 2) + F.cos(phi0) * F.cos(phi) * F.pow(F.sin((lam - lam0) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
