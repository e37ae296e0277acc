"""Geometries of several parts with rings.

A geometry is `struct<type string, parts array<array<array<struct<x, y>>>>>`: parts hold rings, rings hold
vertices. A point is a part with one ring of one vertex, a line a part with one ring; the first ring of
a polygon's part is its outline, the others are holes. MULTI forms have any number of parts, EMPTY
ones none. Z and M values are read over. Only 2-D coordinates are kept.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions import geo

POINTS, LINES, POLYGONS = ("POINT", "MULTIPOINT"), ("LINESTRING", "MULTILINESTRING"), ("POLYGON", "MULTIPOLYGON")
KINDS = (*POINTS, *LINES, *POLYGONS)
#: Names of the kinds in GeoJSON.
JSON_NAMES = {
    "POINT": "Point", "MULTIPOINT": "MultiPoint", "LINESTRING": "LineString", "MULTILINESTRING": "MultiLineString",
    "POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon",
}

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))
# Type objects instead of text: text would need a running session at import.
GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("parts", PARTS)])


def _once(function):
    """The function with its first argument evaluated once, however often it is used."""

    @wraps(function)
    def wrapped(value: Column, *more):
        return geo._let(value, lambda v: function(v, *more))

    return wrapped


def geometry(kind: str | Column, parts: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), parts.alias("parts"))


def st_polygon(*rings: Column) -> Column:
    """A polygon from its outline and holes."""
    return geometry("POLYGON", F.array(F.array(*rings)))


def st_multi_polygon(*polygons: list[Column]) -> Column:
    """Several polygons, each a list of rings."""
    return geometry("MULTIPOLYGON", F.array(*[F.array(*rings) for rings in polygons]))


def st_line(line: Column) -> Column:
    return geometry("LINESTRING", F.array(F.array(line)))


def st_multi_line(*lines: Column) -> Column:
    return geometry("MULTILINESTRING", F.array(*[F.array(x) for x in lines]))


def st_multi_point(*points: Column) -> Column:
    return geometry("MULTIPOINT", F.array(*[F.array(F.array(p)) for p in points]))


def _is(geom: Column, kinds: tuple[str, ...]) -> Column:
    return geom["type"].isin(*kinds)


# --- text forms -------------------------------------------------------------------------


def st_geom_from_text(wkt: Column) -> Column:
    """Parse the six WKT kinds, with Z, M or an SRID prefix; other text and vertices that are no numbers give NULL."""
    head = r"(?is)^\s*(?:SRID=\d+;\s*)?([A-Z]+)\s*(?:ZM|Z|M)?\s*(EMPTY\s*$|\(.*\)\s*$)"
    return geo._let(wkt, lambda t: _from_text(F.struct(F.upper(F.regexp_extract(t, head, 1)).alias("kind"), F.upper(F.regexp_extract(t, head, 2)).alias("body"))))


@_once
def _from_text(read: Column) -> Column:
    kind, body = read["kind"], read["body"]

    def vertex(text: Column) -> Column:
        numbers = F.split(F.trim(F.regexp_replace(text, "[()]", "")), r"\s+")
        return geo.st_point(F.get(numbers, F.lit(0)).try_cast("double"), F.get(numbers, F.lit(1)).try_cast("double"))

    ring = lambda text: F.transform(F.split(text, ","), vertex)
    pieces = lambda text: F.split(text, r"\)\s*,\s*\(")
    polygons = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")
    parts = (
        F.when(kind.isin(*POINTS), F.transform(F.split(body, ","), lambda v: F.array(F.array(vertex(v)))))
        .when(kind == "LINESTRING", F.array(F.array(ring(body))))
        .when(kind == "MULTILINESTRING", F.transform(pieces(body), lambda r: F.array(ring(r))))
        .when(kind == "POLYGON", F.array(F.transform(pieces(body), ring)))
        .when(kind == "MULTIPOLYGON", F.transform(polygons, lambda p: F.transform(pieces(p), ring)))
    )
    parts = F.when(kind.isin(*KINDS) & body.startswith("EMPTY"), F.array().cast(PARTS)).otherwise(parts)
    whole = geo._let(parts, lambda p: F.when(_complete(p) & ((kind != "POINT") | (F.size(p) <= 1)), geometry(kind, p)))
    return F.when(kind.isin(*KINDS), whole)


def _complete(parts: Column) -> Column:
    return F.forall(parts, lambda rings: F.forall(rings, lambda ring: F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull())))


def _joined(values: Column, body) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(values, body), ", "), F.lit(")"))


@_once
def st_as_text(geom: Column) -> Column:
    """WKT of any kind."""
    pair = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    ring = lambda r: _joined(r, pair)
    first, kind = F.get(geom["parts"], F.lit(0)), geom["type"]
    body = (
        F.when(F.size(geom["parts"]) == 0, F.lit("EMPTY"))
        .when(kind.isin("POINT", "LINESTRING"), ring(F.get(first, F.lit(0))))
        .when(kind == "POLYGON", _joined(first, ring))
        .when(kind == "MULTIPOLYGON", _joined(geom["parts"], lambda part: _joined(part, ring)))
        .otherwise(_joined(geom["parts"], lambda part: ring(F.get(part, F.lit(0)))))
    )
    return F.concat(kind, F.lit(" "), body)


@_once
def st_as_geojson(geom: Column) -> Column:
    """GeoJSON text of any kind."""
    kind = geom["type"]
    name = F.create_map(*[F.lit(x) for pair in JSON_NAMES.items() for x in pair])[kind]
    deep = F.transform(geom["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    level = lambda rings: F.transform(rings, lambda r: F.get(r, F.lit(0)))

    def text(parts: Column) -> Column:
        first = F.get(parts, F.lit(0))
        return (
            F.when(F.size(parts) == 0, F.lit("[]"))
            .when(kind == "POINT", F.to_json(F.get(F.get(first, F.lit(0)), F.lit(0))))
            .when(kind == "LINESTRING", F.to_json(F.get(first, F.lit(0))))
            .when(kind == "POLYGON", F.to_json(first))
            .when(kind == "MULTIPOINT", F.to_json(level(level(parts))))
            .when(kind == "MULTILINESTRING", F.to_json(level(parts)))
            .otherwise(F.to_json(parts))
        )

    return F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), geo._let(deep, text), F.lit("}"))


def st_from_geojson(text: Column) -> Column:
    """GeoJSON geometry text of any of the six kinds; other text gives NULL, further coordinates of a position are left out."""
    return geo._let(text, lambda t: _from_geojson(F.struct(F.upper(F.get_json_object(t, "$.type")).alias("kind"), F.get_json_object(t, "$.coordinates").alias("coords"))))


@_once
def _from_geojson(found: Column) -> Column:
    kind, coords = found["kind"], found["coords"]
    read = lambda depth: F.from_json(coords, "array<" * depth + "double" + ">" * depth)
    vertex = lambda p: geo.st_point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))
    ring = lambda r: F.transform(r, vertex)
    parts = (
        F.when(kind == "POINT", F.array(F.array(F.array(vertex(read(1))))))
        .when(kind == "MULTIPOINT", F.transform(read(2), lambda p: F.array(F.array(vertex(p)))))
        .when(kind == "LINESTRING", F.array(F.array(ring(read(2)))))
        .when(kind == "MULTILINESTRING", F.transform(read(3), lambda r: F.array(ring(r))))
        .when(kind == "POLYGON", F.array(F.transform(read(3), ring)))
        .when(kind == "MULTIPOLYGON", F.transform(read(4), lambda p: F.transform(p, ring)))
    )
    # `[]` stands for an empty geometry; a null on any level is no geometry.
    parts = F.when(F.regexp_like(coords, F.lit(r"^\s*\[\s*\]\s*$")), F.array().cast(PARTS)).otherwise(parts)
    return geo._let(parts, lambda p: F.when(_complete(p), geometry(kind, p)))


# --- measures ---------------------------------------------------------------------------


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring in square degrees, positive where it runs counter-clockwise."""
    return geo._total(F.transform(geo._cross_terms(ring), lambda t: t["w"])) / 2


def _over_polygons(geom: Column, of_ring) -> Column:
    """Sum over parts of the outline's value less the holes' values; 0 for points and lines."""
    part = lambda rings: geo._total(F.transform(rings, lambda r, i: of_ring(r) * F.when(i == 0, 1.0).otherwise(-1.0)))
    return F.when(_is(geom, POLYGONS), geo._total(F.transform(geom["parts"], part))).when(geom["type"].isNotNull(), F.lit(0.0))


@_once
def st_area_planar(geom: Column) -> Column:
    """Area in square degrees: outlines less holes, over all parts."""
    return _over_polygons(geom, geo.st_area_planar)


@_once
def st_area_geog(geom: Column) -> Column:
    """Area on the spheroid in square metres: outlines less holes, over all parts."""
    return _over_polygons(geom, geo.st_area_geog)


@_once
def st_length_geog(geom: Column) -> Column:
    """Metres of all lines; 0 for points and polygons, whose length is their perimeter."""
    return F.when(_is(geom, LINES), _all_rings(geom)).when(geom["type"].isNotNull(), F.lit(0.0))


@_once
def st_perimeter_geog(geom: Column) -> Column:
    """Metres of all rings of polygons, holes too."""
    return F.when(_is(geom, POLYGONS), _all_rings(geom)).when(geom["type"].isNotNull(), F.lit(0.0))


def _all_rings(geom: Column) -> Column:
    return geo._total(F.transform(F.flatten(geom["parts"]), geo.st_length_geog))


@_once
def st_centroid(geom: Column) -> Column:
    """Centre of mass: by area less holes for polygons, by planar length for lines, the mean of points.

    Where the area (length) is zero, the next lower kind of mass counts; NULL for EMPTY.
    """
    origin = F.get(F.get(F.get(geom["parts"], F.lit(0)), F.lit(0)), F.lit(0))
    mass = lambda w, x, y: F.struct(w.alias("w"), (w * x).alias("wx"), (w * y).alias("wy"))

    def centre(masses: Column) -> Column:
        def point(m: Column) -> Column:
            field = lambda c: geo._total(F.transform(m, lambda t: t[c]))
            w, x, y = field("w"), field("wx"), field("wy")
            return F.when(w != 0, geo.st_point(x / w, y / w))

        return geo._let(masses, point)

    def ring_mass(ring: Column, i: Column) -> Column:
        c, sign = geo.st_centroid(ring), F.when(i == 0, 1.0).otherwise(-1.0)
        return mass(sign * geo.st_area_planar(ring), c["x"] - origin["x"], c["y"] - origin["y"])

    def segment_mass(s: Column) -> Column:
        dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
        return mass(F.sqrt(dx * dx + dy * dy), (s["a"]["x"] + s["b"]["x"]) / 2 - origin["x"], (s["a"]["y"] + s["b"]["y"]) / 2 - origin["y"])

    areas = F.flatten(F.transform(geom["parts"], lambda rings: F.transform(rings, ring_mass)))
    segments = F.transform(F.flatten(F.transform(F.flatten(geom["parts"]), geo._segments)), segment_mass)
    vertices = F.transform(F.flatten(F.flatten(geom["parts"])), lambda p: mass(F.lit(1.0), p["x"] - origin["x"], p["y"] - origin["y"]))
    by_length = F.coalesce(F.when(~_is(geom, POINTS), centre(segments)), centre(vertices))
    best = F.coalesce(F.when(_is(geom, POLYGONS), centre(areas)), by_length)
    return geo._let(best, lambda c: F.when(c.isNotNull(), geo.st_point(c["x"] + origin["x"], c["y"] + origin["y"])))


@_once
def st_envelope(geom: Column) -> Column:
    """Least box: struct<minx, miny, maxx, maxy>; nulls for EMPTY."""
    values = lambda c: F.transform(F.flatten(F.flatten(geom["parts"])), lambda p: p[c])
    return F.struct(*[f(values(c)).alias(f"{n}{c}") for n, f in (("min", F.array_min), ("max", F.array_max)) for c in "xy"])


# --- structure --------------------------------------------------------------------------


def st_num_parts(geom: Column) -> Column:
    return F.size(geom["parts"])


@_once
def st_dump(geom: Column) -> Column:
    """The parts as single geometries, polygons with their holes; a single geometry is its only part."""
    single = F.regexp_replace(geom["type"], "^MULTI", "")
    return F.transform(geom["parts"], lambda part: geometry(single, F.array(part)))


def st_dump_rings(geom: Column) -> Column:
    """Every ring with the numbers of its part and place: array<struct<part, ring, line>>; ring 0 is the outline."""
    own = F.transform(geom["parts"], lambda part, i: F.transform(part, lambda r, j: F.struct(i.alias("part"), j.alias("ring"), r.alias("line"))))
    return F.flatten(own)


@_once
def st_orient(geom: Column) -> Column:
    """Polygons with outlines counter-clockwise and holes clockwise; other kinds as they are."""
    turned = lambda r, i: F.when((signed_area(r) < 0) == (i == 0), F.reverse(r)).otherwise(r)
    parts = F.transform(geom["parts"], lambda part: F.transform(part, turned))
    return F.when(_is(geom, POLYGONS), geometry(geom["type"], parts)).otherwise(geom)


@_once
def st_contains_point(geom: Column, x: Column, y: Column) -> Column:
    """Whether a polygon has the point strictly inside: in an outline, in none of its holes and on no border."""

    def within(rings: Column) -> Column:
        crossed = F.aggregate(F.transform(rings, lambda r: geo.point_in_ring(x, y, r).cast("int")), F.lit(0), lambda a, b: a + b)
        return crossed % 2 == 1

    here = geo.st_point(x, y)
    border = F.exists(F.flatten(geom["parts"]), lambda r: F.exists(geo._segments(r), lambda s: geo._on_segment(s["a"], s["b"], here)))
    return _is(geom, POLYGONS) & ~border & F.exists(geom["parts"], within)


def st_intersects(a: Column, b: Column) -> Column:
    """Whether two polygon geometries share a point, holes left out: borders touch, or a part of one lies in the other."""
    corner = lambda rings: F.get(F.get(rings, F.lit(0)), F.lit(0))

    def meet(v: Column) -> Column:
        one, two = F.flatten(v["a"]["parts"]), F.flatten(v["b"]["parts"])
        touch = F.exists(one, lambda r: F.exists(two, lambda s: geo.lines_intersect(r, s)))
        held = lambda outer, inner: F.exists(inner["parts"], lambda part: st_contains_point(outer, corner(part)["x"], corner(part)["y"]))
        return touch | held(v["a"], v["b"]) | held(v["b"], v["a"])

    return geo._let(F.struct(a.alias("a"), b.alias("b")), meet)


@_once
def st_problem(geom: Column) -> Column:
    """Why a polygon's rings are not valid, or NULL; other kinds only need finite coordinates."""
    problems = F.transform(F.flatten(geom["parts"]), geo.ring_problem)
    first = F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0))
    return F.when(geom.isNull(), "null").when(_is(geom, POLYGONS), first)


@_once
def st_make_valid(geom: Column) -> Column:
    """Limited repair of polygons: repeated vertices go, rings are closed and turned the usual way."""
    parts = F.transform(geom["parts"], lambda part: F.transform(part, geo.st_make_valid_ring))
    return F.when(_is(geom, POLYGONS), st_orient(geometry(geom["type"], parts))).otherwise(geom)
