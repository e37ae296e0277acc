"""Geometry as columns.

A ring or line is `array<struct<x double, y double>>` (lon/lat degrees, EPSG:4326); geometries of
several rings and parts are in `shapes`. All functions here are plain expressions.
Angles are degrees, lengths metres, areas square metres unless a name says planar.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84 and spherical constants (fixed values).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
EARTH_RADIUS = 6371008.8
MERCATOR_RADIUS = 6378137.0
METRES_PER_DEGREE = 111320.0


def _let(value: Column, body) -> Column:
    """Evaluate `value` once and use it several times in `body` (a lambda variable is not re-computed)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def st_point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"))


def st_make_line(*points: Column) -> Column:
    return F.array(*points)


def st_rectangle(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed ring of an axis-parallel rectangle."""
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    return F.array(*[st_point(x, y) for x, y in corners])


# --- measures on rings and lines --------------------------------------------------------


def _segments(line: Column) -> Column:
    """Consecutive vertex pairs as `array<struct<a, b>>`."""
    heads = F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0)))
    tails = F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))
    return F.zip_with(heads, tails, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _cross_terms(ring: Column) -> Column:
    # Coordinates relative to the first vertex: keeps small polygons accurate.
    o = F.element_at(ring, 1)
    return F.transform(
        _segments(ring),
        lambda s: F.struct(
            (
                (s["a"]["x"] - o["x"]) * (s["b"]["y"] - o["y"]) - (s["b"]["x"] - o["x"]) * (s["a"]["y"] - o["y"])
            ).alias("w"),
            (s["a"]["x"] + s["b"]["x"] - 2 * o["x"]).alias("sx"),
            (s["a"]["y"] + s["b"]["y"] - 2 * o["y"]).alias("sy"),
        ),
    )


def st_area_planar(ring: Column) -> Column:
    """Shoelace area of a closed ring, in square degrees."""
    return F.abs(_total(F.transform(_cross_terms(ring), lambda t: t["w"]))) / 2


def st_centroid(ring: Column) -> Column:
    """Area-weighted centroid of a closed ring; its first vertex when the area is zero."""

    def from_terms(terms: Column) -> Column:
        area3 = 3 * _total(F.transform(terms, lambda t: t["w"]))
        sx = _total(F.transform(terms, lambda t: t["w"] * t["sx"]))
        sy = _total(F.transform(terms, lambda t: t["w"] * t["sy"]))
        first = F.element_at(ring, 1)
        return st_point(
            first["x"] + F.coalesce(F.try_divide(sx, area3), F.lit(0.0)),
            first["y"] + F.coalesce(F.try_divide(sy, area3), F.lit(0.0)),
        )

    return _let(_cross_terms(ring), from_terms)


def authalic_y(lat: Column) -> Column:
    """Northing of the equal-area cylindrical projection of the WGS 84 spheroid."""
    e = math.sqrt(WGS84_E2)
    s = F.sin(F.radians(lat))
    q = (1 - WGS84_E2) * (s / (1 - WGS84_E2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    return q * (WGS84_A * WGS84_A / 2)


def st_area_geog(ring: Column) -> Column:
    """Area on the spheroid: shoelace in the equal-area projection."""
    projected = F.transform(
        ring, lambda p: F.struct(F.radians(p["x"]).alias("x"), authalic_y(p["y"]).alias("y"))
    )
    return st_area_planar(projected)


def rect_area_geog(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed form of `st_area_geog` for a rectangle."""
    return F.abs(F.radians(maxx - minx) * (authalic_y(maxy) - authalic_y(miny)))


def st_length_geog(line: Column) -> Column:
    """Sum of spheroidal vertex distances."""
    return _total(
        F.transform(
            _segments(line),
            lambda s: spheroid_m(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]),
        )
    )


def st_start_point(line: Column) -> Column:
    return F.element_at(line, 1)


def st_end_point(line: Column) -> Column:
    return F.element_at(line, -1)


def st_segmentize(line: Column, max_length: float) -> Column:
    """Densify so that no planar segment exceeds `max_length` degrees."""

    def cut(s: Column) -> Column:
        dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
        parts = F.greatest(F.lit(1), F.ceil(F.sqrt(dx * dx + dy * dy) / F.lit(max_length)).cast("int"))
        return F.transform(
            F.sequence(F.lit(0), parts - 1),
            lambda i: st_point(s["a"]["x"] + dx * i / parts, s["a"]["y"] + dy * i / parts),
        )

    return F.concat(F.flatten(F.transform(_segments(line), cut)), F.array(F.element_at(line, -1)))


# --- predicates -------------------------------------------------------------------------


def st_within_bbox(x: Column, y: Column, minx, miny, maxx, maxy) -> Column:
    """Point strictly inside a box: a point on the border is not within."""
    return (x > minx) & (x < maxx) & (y > miny) & (y < maxy)


def rect_intersects(a: tuple, b: tuple) -> Column:
    """Axis-parallel rectangles `(minx, miny, maxx, maxy)` share at least a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray casting."""

    def crosses(s: Column) -> Column:
        ay, by = s["a"]["y"], s["b"]["y"]
        straddles = (ay > y) != (by > y)
        at = s["a"]["x"] + (y - ay) * F.try_divide(s["b"]["x"] - s["a"]["x"], by - ay)
        return F.when(straddles & (x < at), 1).otherwise(0)

    hits = F.aggregate(F.transform(_segments(ring), crosses), F.lit(0), lambda acc, v: acc + v)
    return hits % 2 == 1


def _turn(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def _on_segment(a: Column, b: Column, p: Column) -> Column:
    return (
        (_turn(a, b, p) == 0)
        & p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
        & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
    )


def _segments_touch(s: Column, t: Column) -> Column:
    a, b, c, d = s["a"], s["b"], t["a"], t["b"]
    proper = (F.signum(_turn(a, b, c)) * F.signum(_turn(a, b, d)) < 0) & (
        F.signum(_turn(c, d, a)) * F.signum(_turn(c, d, b)) < 0
    )
    return proper | _on_segment(a, b, c) | _on_segment(a, b, d) | _on_segment(c, d, a) | _on_segment(c, d, b)


def lines_intersect(a: Column, b: Column) -> Column:
    return F.exists(_segments(a), lambda s: F.exists(_segments(b), lambda t: _segments_touch(s, t)))


def polygons_intersect(a: Column, b: Column) -> Column:
    """Two closed rings: borders touch, or one contains the other."""

    def meet(v: Column) -> Column:
        pa, pb = F.element_at(v["a"], 1), F.element_at(v["b"], 1)
        return (
            lines_intersect(v["a"], v["b"])
            | point_in_ring(pa["x"], pa["y"], v["b"])
            | point_in_ring(pb["x"], pb["y"], v["a"])
        )

    return _let(F.struct(a.alias("a"), b.alias("b")), meet)


def ring_problem(ring: Column) -> Column:
    """Why a polygon ring is not valid, or NULL when it is."""
    return _let(ring, _problem)


def _problem(ring: Column) -> Column:
    finite = F.forall(
        ring,
        lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
        & (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")),
    )
    last = F.size(ring) - 2  # index of the last segment

    def crosses(segs: Column) -> Column:
        return F.exists(
            segs,
            lambda s: F.exists(
                segs,
                lambda t: (t["i"] > s["i"] + 1) & ~((s["i"] == 0) & (t["i"] == last)) & _segments_touch(s, t),
            ),
        )

    indexed = F.transform(_segments(ring), lambda s, i: F.struct(s["a"].alias("a"), s["b"].alias("b"), i.alias("i")))
    crossing = _let(indexed, crosses)
    return (
        F.when(ring.isNull(), "null")
        .when(~finite, "not finite")
        .when(F.size(ring) < 4, "too few points")
        .when(F.element_at(ring, 1) != F.element_at(ring, -1), "not closed")
        .when(crossing, "self intersection")
    )


def st_make_valid_ring(ring: Column) -> Column:
    """Limited repair: drop repeated consecutive vertices, then close the ring."""

    def distinct(r: Column) -> Column:
        return F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, F.greatest(i - 1, F.lit(0)))))

    def close(r: Column) -> Column:
        first = F.element_at(r, 1)
        return F.when(first == F.element_at(r, -1), r).otherwise(F.concat(r, F.array(first)))

    return _let(_let(ring, distinct), close)


# --- distances --------------------------------------------------------------------------


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance on the mean sphere (within 0.5 % of the spheroid)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def spheroid_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance on WGS 84 by Lambert's formula: about 10 parts per million, no iteration."""
    b1 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat1)))
    b2 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat2)))
    h = F.pow(F.sin((b2 - b1) / 2), F.lit(2)) + F.cos(b1) * F.cos(b2) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), F.lit(2)
    )
    half = F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    arc = 2 * half
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    # Both corrections vanish for equal points; try_divide keeps the antipode from failing.
    x = (arc - F.sin(arc)) * F.coalesce(
        F.try_divide(F.pow(F.sin(p) * F.cos(q), F.lit(2)), F.pow(F.cos(half), F.lit(2))), F.lit(0.0)
    )
    y = (arc + F.sin(arc)) * F.coalesce(
        F.try_divide(F.pow(F.cos(p) * F.sin(q), F.lit(2)), F.pow(F.sin(half), F.lit(2))), F.lit(0.0)
    )
    return F.lit(WGS84_A) * (arc - F.lit(WGS84_F / 2) * (x + y))


def closest_on_rect(x: Column, y: Column, minx, miny, maxx, maxy) -> Column:
    """Planar closest point of a filled rectangle."""
    return st_point(F.greatest(minx, F.least(x, maxx)), F.greatest(miny, F.least(y, maxy)))


def closest_on_segment(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar closest point of a segment."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((x - x1) * dx + (y - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return st_point(x1 + t * dx, y1 + t * dy)


def st_closest_point(x: Column, y: Column, line: Column) -> Column:
    """Planar closest point of a polyline."""

    def candidate(s: Column) -> Column:
        p = closest_on_segment(x, y, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
        return F.struct(planar_distance(x, y, p["x"], p["y"]).alias("d"), p["x"].alias("x"), p["y"].alias("y"))

    best = F.array_min(F.transform(_segments(line), candidate))
    return st_point(best["x"], best["y"])


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


# --- projections and tiles --------------------------------------------------------------


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * MERCATOR_RADIUS


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS


def st_transform_3857(point: Column) -> Column:
    return st_point(mercator_x(point["x"]), mercator_y(point["y"]))


def st_transform_4326(point: Column) -> Column:
    """Web mercator back to lon/lat."""
    lat = 2 * F.atan(F.exp(point["y"] / MERCATOR_RADIUS)) - math.pi / 2
    return st_point(F.degrees(point["x"] / MERCATOR_RADIUS), F.degrees(lat))


def tile_x(lon: Column, zoom: Column) -> Column:
    n = F.shiftleft(F.lit(1), zoom) if isinstance(zoom, int) else F.pow(F.lit(2.0), zoom)
    return F.floor((lon + 180.0) / 360.0 * n).cast("long")


def tile_y(lat: Column, zoom: Column) -> Column:
    n = F.shiftleft(F.lit(1), zoom) if isinstance(zoom, int) else F.pow(F.lit(2.0), zoom)
    return F.floor((F.lit(0.5) - mercator_y(lat) / (2 * math.pi * MERCATOR_RADIUS)) * n).cast("long")
