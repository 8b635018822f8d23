"""Plane geometry on coordinate arrays.

A polygon's outline is one array of edges ``struct<x1,y1,x2,y2>`` holding the
outer ring and the holes alike: the even-odd rule then handles holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS 80 ellipsoid and the Lambert conic parameters of EPSG:3948.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
ORIGIN_LATITUDE = 48.0
ORIGIN_LONGITUDE = 3.0
PARALLEL_1 = 47.25
PARALLEL_2 = 48.75
FALSE_EASTING = 1700000.0
FALSE_NORTHING = 7200000.0


def conic_constants() -> dict[str, float]:
    """Cone constant, radius factor and origin radius of the projection."""
    flattening = 1 / INVERSE_FLATTENING
    ecc = math.sqrt(2 * flattening - flattening**2)

    def m(lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (ecc * math.sin(lat)) ** 2)

    def t(lat: float) -> float:
        es = ecc * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - es) / (1 + es)) ** (ecc / 2)

    lat1, lat2, lat0 = (math.radians(v) for v in (PARALLEL_1, PARALLEL_2, ORIGIN_LATITUDE))
    n = (math.log(m(lat1)) - math.log(m(lat2))) / (math.log(t(lat1)) - math.log(t(lat2)))
    radius = SEMI_MAJOR * m(lat1) / (n * t(lat1) ** n)
    return {"ecc": ecc, "n": n, "radius": radius, "origin": radius * t(lat0) ** n}


def project_point(latitude: Column, longitude: Column) -> tuple[Column, Column]:
    """WGS 84 degrees -> metres east and north."""
    k = conic_constants()
    lat = F.radians(latitude)
    es = F.lit(k["ecc"]) * F.sin(lat)
    t = F.tan(F.lit(math.pi / 4) - lat / 2) / F.pow((1 - es) / (1 + es), F.lit(k["ecc"] / 2))
    r = F.lit(k["radius"]) * F.pow(t, F.lit(k["n"]))
    theta = F.lit(k["n"]) * F.radians(longitude - ORIGIN_LONGITUDE)
    return FALSE_EASTING + r * F.sin(theta), FALSE_NORTHING + k["origin"] - r * F.cos(theta)


def ring_edges(rings: Column) -> Column:
    """``array<array<struct<x,y>>>`` -> edges of all rings, each ring closed."""

    def edges_of(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")
            ),
        )

    return F.flatten(F.transform(rings, edges_of))


def _side(e: Column, x: Column, y: Column) -> Column:
    """Twice the area of edge and point; its sign tells the side."""
    return (e.x2 - e.x1) * (y - e.y1) - (x - e.x1) * (e.y2 - e.y1)


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    return (
        (_side(e, x, y) == 0)
        & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
        & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
    )


def contained_in_cell(edges: Column, inside: Column, corner: tuple[Column, Column], x: Column, y: Column) -> Column:
    """True inside, for a point of a cell whose lower left corner is ``inside`` or not, from the edges
    that pass the cell: the state changes with each edge between the point, the cell's left side at its
    height, and the corner. A point on the outline is not contained."""
    left, bottom = corner

    def changes(e: Column) -> Column:
        at_side = _side(e, left, y) > 0
        beside = ((e.y1 > y) != (e.y2 > y)) & ((_side(e, x, y) > 0) != at_side)
        below = ((e.x1 > left) != (e.x2 > left)) & (at_side != (_side(e, left, bottom) > 0))
        return beside.cast("int") + below.cast("int")

    state = F.aggregate(edges, inside.cast("int"), lambda n, e: n + changes(e))
    return (state % 2 == 1) & ~F.exists(edges, lambda e: _on_edge(e, x, y))


def edge_distance(edges: Column, x: Column, y: Column) -> Column:
    """Shortest distance from the point to the edges, null without any: to an end of the edge where the
    foot of the perpendicular falls outside it, else the height over the edge."""

    def square(v: Column) -> Column:
        return F.pow(v, F.lit(2.0))

    def squared(e: Column) -> Column:
        along = (x - e.x1) * (e.x2 - e.x1) + (y - e.y1) * (e.y2 - e.y1)
        length2 = square(e.x2 - e.x1) + square(e.y2 - e.y1)
        return (
            F.when(along <= 0, square(x - e.x1) + square(y - e.y1))
            .when(along >= length2, square(x - e.x2) + square(y - e.y2))
            .otherwise(square(_side(e, x, y)) / length2)
        )

    return F.sqrt(F.array_min(F.transform(edges, squared)))
