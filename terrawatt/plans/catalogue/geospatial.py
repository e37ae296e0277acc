"""Geometry functions and spatial joins."""

import math

from pyspark.sql import functions as F

from terrawatt.functions import geo, shapes
from terrawatt.functions.kernels import st_as_wkb, st_distance_vincenty, st_geom_from_wkb
from terrawatt.operators import aggregates as agg
from terrawatt.operators import cleaning as cl
from terrawatt.operators import clipping as clip
from terrawatt.operators import spatial as sp
from terrawatt.plans.registry import query

CENTRE = (55.4, 25.0)


def haversine(lon1, lat1, lon2, lat2) -> str:
    return f"""2 * {geo.EARTH_RADIUS} * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) +
        cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def spheroid(lon1, lat1, lon2, lat2) -> str:
    """Lambert's formula as a scalar subquery over named intermediates."""
    f, a = repr(geo.WGS84_F), geo.WGS84_A
    return f"""(SELECT {a} * (arc - {f} / 2 * ((arc - sin(arc)) * coalesce(pow(sin(p) * cos(q), 2) / nullif(pow(cos(arc / 2), 2), 0), 0)
        + (arc + sin(arc)) * coalesce(pow(cos(p) * sin(q), 2) / nullif(pow(sin(arc / 2), 2), 0), 0)))
        FROM (SELECT 2 * asin(least(1.0, sqrt(pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))) AS arc,
        (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q FROM (SELECT atan((1 - {f}) * tan(radians({lat1}))) AS b1,
        atan((1 - {f}) * tan(radians({lat2}))) AS b2)))"""


def authalic(lat: str) -> str:
    e, e2 = repr(math.sqrt(geo.WGS84_E2)), repr(geo.WGS84_E2)
    return f"""((1 - {e2}) * (sin(radians({lat})) / (1 - {e2} * pow(sin(radians({lat})), 2)) -
        ln((1 - {e} * sin(radians({lat}))) / (1 + {e} * sin(radians({lat})))) / (2 * {e})) * {geo.WGS84_A ** 2 / 2})"""


RECT_AREA = f"abs(radians(maxx - minx) * ({authalic('maxy')} - {authalic('miny')}))"
BOX = ("minx", "miny", "maxx", "maxy")


def ring(t=None):
    return geo.st_rectangle(*[F.col(c) for c in BOX])


@query("st_point", "SELECT id, lon AS x, lat AS y FROM points", "x y")
def _(t):
    return t.points.select("id", geo.st_point(F.col("lon"), F.col("lat")).alias("p")).select("id", "p.x", "p.y")


def spread(df):
    """Rows over all cores: a small file would be one task. What they hold is computed once, before any use of it."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


# Features of every kind from the buildings' boxes, by building_id % 6: none, a point, a line, a box with a
# hole of half its sides in the middle, that and the same box twice its width to the right, and two lines.
KIND = "['NONE', 'POINT', 'LINESTRING', 'POLYGON', 'MULTIPOLYGON', 'MULTILINESTRING'][building_id % 6 + 1]"
HOLED = "SELECT *, maxx - minx AS w, maxy - miny AS h, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM building_geom"


def features(t):
    minx, miny, maxx, maxy = (F.col(c) for c in BOX)
    w, h = maxx - minx, maxy - miny
    hole = F.reverse(geo.st_rectangle(minx + w / 4, miny + h / 4, maxx - w / 4, maxy - h / 4))
    beside = geo.st_rectangle(minx + 2 * w, miny, maxx + 2 * w, maxy)
    side = lambda y: F.array(geo.st_point(minx, y), geo.st_point(maxx, y))
    kinds = [
        shapes.geometry("POINT", F.array(F.array(F.array(geo.st_point(minx, miny))))),
        shapes.st_line(F.array(geo.st_point(minx, miny), geo.st_point(maxx, maxy))),
        shapes.st_polygon(ring(), hole), shapes.st_multi_polygon([ring(), hole], [beside]), shapes.st_multi_line(side(miny), side(maxy)),
    ]
    geom = F.lit(None).cast(shapes.GEOMETRY)
    for k, g in enumerate(kinds, 1):
        geom = F.when(F.col("building_id") % 6 == k, g).otherwise(geom)
    return spread(t.building_geom.select("building_id", *BOX, geom.alias("geom")))


AREA = "CASE building_id % 6 WHEN 3 THEN 0.75 WHEN 4 THEN 1.75 ELSE 0 END * w * h * 1e6"


@query("st_geom_from_text", """SELECT p_partkey AS page_no, ['POLYGON', 'MULTIPOLYGON', 'MULTILINESTRING', 'MULTIPOINT'][p_partkey % 4 + 1] AS type,
    [1, 2, 2, 3][p_partkey % 4 + 1] AS parts, [2, 3, 2, 3][p_partkey % 4 + 1] AS rings, [9, 13, 5, 3][p_partkey % 4 + 1] AS vertices,
    CAST(p_partkey AS DOUBLE) / 4 + [0.25, 5, 3, 2][p_partkey % 4 + 1] AS last_x, [2.75, 2.5, -4, 1e-3][p_partkey % 4 + 1] AS last_y FROM part""", "last_x last_y")
def _(t):
    k = F.col("p_partkey").cast("double") / 4
    at = lambda x, y: F.concat((k + x).cast("string"), F.lit(f" {y}"))
    row = lambda *corners: F.concat(F.lit("("), F.concat_ws(", ", *[at(*c) for c in corners]), F.lit(")"))
    join = lambda *texts: F.concat(F.lit("("), F.concat_ws(" ,", *texts), F.lit(")"))
    box, hole = row((0, 2.5), (1, 2.5), (1, 3.5), (0, 3.5), (0, 2.5)), row((0.25, 2.75), (0.5, 3.25), (0.75, 2.75), (0.25, 2.75))
    text = [
        F.concat(F.lit("POLYGON"), join(box, hole)),
        F.concat(F.lit("SRID=4326; MultiPolygon "), join(join(box, hole), join(row((5, 2.5), (6, 2.5), (5, 4), (5, 2.5))))),
        F.concat(F.lit("MULTILINESTRING Z"), join(row((0, "1 9"), (1, "1 9")), row((1, "2 9"), (2, "2 9"), (3, "-4 9")))),
        F.concat(F.lit("multipoint "), join(row((0, 1)), row((1, 1)), row((2, "1e-3")))),
    ]
    wkt = F.get(F.array(*text), (F.col("p_partkey") % 4).cast("int"))
    parsed = t.part.select(F.col("p_partkey").alias("page_no"), shapes.st_geom_from_text(wkt).alias("g"))
    rings = parsed.withColumn("rings", F.flatten("g.parts")).withColumn("last", F.element_at(F.flatten("rings"), -1))
    return rings.select(
        "page_no", "g.type", F.size("g.parts").alias("parts"), F.size("rings").alias("rings"), F.size(F.flatten("rings")).alias("vertices"),
        F.col("last.x").alias("last_x"), F.col("last.y").alias("last_y"),
    )


@query("st_as_text", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN concat('LINESTRING (', k, '.5 1.25, ', k, '.75 2.5)')
    WHEN 1 THEN concat('POLYGON ((', k, '.0 0.0, ', k, '.5 0.0, ', k, '.0 4.0, ', k, '.0 0.0), (', k, '.0 1.0, ', k, '.25 1.0, ', k, '.0 2.0, ', k, '.0 1.0))')
    ELSE concat('MULTIPOLYGON (((', k, '.0 0.0, ', k, '.5 0.0, ', k, '.0 4.0, ', k, '.0 0.0), (', k, '.0 1.0, ', k, '.25 1.0, ', k, '.0 2.0, ', k, '.0 1.0)), ((',
         k, '.75 1.0, ', k, '.5 2.0, ', k, '.75 2.0, ', k, '.75 1.0)))') END AS wkt
    FROM (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS k FROM supplier)""")
def _(t):
    return t.supplier.select("s_suppkey", shapes.st_as_text(small_feature()).alias("wkt"))


def small_feature():
    """By s_suppkey % 3: a line, a triangle with a hole, that and another triangle."""
    x = F.col("s_suppkey").cast("double")
    row = lambda *corners: F.array(*[geo.st_point(x + a, F.lit(float(b))) for a, b in corners])
    outline, hole = row((0, 0), (0.5, 0), (0, 4), (0, 0)), row((0, 1), (0.25, 1), (0, 2), (0, 1))
    both = shapes.st_multi_polygon([outline, hole], [row((0.75, 1), (0.5, 2), (0.75, 2), (0.75, 1))])
    kind = F.col("s_suppkey") % 3
    return F.when(kind == 0, shapes.st_line(row((0.5, 1.25), (0.75, 2.5)))).when(kind == 1, shapes.st_polygon(outline, hole)).otherwise(both)


@query("st_geom_from_wkb", f"""SELECT building_id, {KIND} AS type, [1, 1, 1, 2, 2][building_id % 6] AS parts, [1, 1, 2, 3, 2][building_id % 6] AS rings,
    {AREA} AS area, minx AS first_x FROM ({HOLED}) WHERE building_id % 6 <> 0
    UNION ALL SELECT -id, 'POINT', 1, 1, 0, lon FROM points""", "area first_x")
def _(t):
    """Every kind to bytes and back, and points with a reference system, Z and M in the extended form."""
    import struct

    import pandas as pd

    @F.pandas_udf("binary")
    def extended(lon: pd.Series, lat: pd.Series) -> pd.Series:
        return pd.Series([struct.pack(">BIIdddd", 0, 0xE0000001, 4326, x, y, 7.0, 8.0) for x, y in zip(lon, lat)])

    rows = features(t).where("geom IS NOT NULL").select("building_id", st_as_wkb("geom").alias("wkb"))
    rows = rows.unionByName(t.points.select((-F.col("id")).alias("building_id"), extended("lon", "lat").alias("wkb")))
    decoded = rows.select("building_id", st_geom_from_wkb("wkb").alias("g"))
    first = F.get(F.flatten(F.flatten("g.parts")), F.lit(0))
    return decoded.select(
        "building_id", "g.type", F.size("g.parts").alias("parts"), F.size(F.flatten("g.parts")).alias("rings"),
        (shapes.st_area_planar(F.col("g")) * 1e6).alias("area"), first["x"].alias("first_x"),
    )


@query("st_as_geojson", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN concat('{"type":"LineString","coordinates":[[', k, '.5,1.25],[', k, '.75,2.5]]}')
    WHEN 1 THEN concat('{"type":"Polygon","coordinates":[[[', k, '.0,0.0],[', k, '.5,0.0],[', k, '.0,4.0],[', k, '.0,0.0]],[[', k, '.0,1.0],[', k, '.25,1.0],[', k, '.0,2.0],[', k, '.0,1.0]]]}')
    ELSE concat('{"type":"MultiPolygon","coordinates":[[[[', k, '.0,0.0],[', k, '.5,0.0],[', k, '.0,4.0],[', k, '.0,0.0]],[[', k, '.0,1.0],[', k, '.25,1.0],[', k, '.0,2.0],[', k, '.0,1.0]]],[[[',
         k, '.75,1.0],[', k, '.5,2.0],[', k, '.75,2.0],[', k, '.75,1.0]]]]}') END AS geojson
    FROM (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS k FROM supplier)""")
def _(t):
    return t.supplier.select("s_suppkey", shapes.st_as_geojson(small_feature()).alias("geojson"))


@query("st_text_round_trip", f"SELECT building_id, {KIND} AS type, TRUE AS by_text, TRUE AS by_json FROM building_geom WHERE building_id % 6 <> 0")
def _(t):
    """Text and GeoJSON of every kind are read back as the same geometry."""
    g = F.col("geom")
    text, json = shapes.st_geom_from_text(shapes.st_as_text(g)), shapes.st_from_geojson(shapes.st_as_geojson(g))
    return features(t).where(g.isNotNull()).select("building_id", "geom.type", text.eqNullSafe(g).alias("by_text"), json.eqNullSafe(g).alias("by_json"))


@query("st_within_bbox", "SELECT id FROM points WHERE lon > 55.0 AND lon < 55.9 AND lat > 24.8 AND lat < 25.2")
def _(t):
    return t.points.where(geo.st_within_bbox(F.col("lon"), F.col("lat"), 55.0, 24.8, 55.9, 25.2)).select("id")


@query("st_within_polygon", """SELECT id FROM points WHERE lon > 54.90003 AND lat > 24.63003 AND lon + lat < 80.53006
    AND NOT (lon BETWEEN 55.00003 AND 55.20003 AND lat BETWEEN 24.70003 AND 24.90003)
    UNION ALL SELECT id FROM points WHERE lon BETWEEN 55.80003 AND 55.90003 AND lat BETWEEN 25.20003 AND 25.30003""")
def _(t):
    """A triangle with a hole and a box beside it; no point lies on a border."""
    at = lambda *corners: F.array(*[geo.st_point(F.lit(x), F.lit(y)) for x, y in corners])
    triangle = at((54.90003, 24.63003), (55.90003, 24.63003), (54.90003, 25.63003), (54.90003, 24.63003))
    box = lambda *edges: geo.st_rectangle(*[F.lit(v) for v in edges])
    zone = shapes.st_multi_polygon([triangle, box(55.00003, 24.70003, 55.20003, 24.90003)], [box(55.80003, 25.20003, 55.90003, 25.30003)])
    return t.points.where(shapes.st_contains_point(zone, F.col("lon"), F.col("lat"))).select("id")


@query("st_make_valid", "SELECT building_id, 10 AS vertices, CAST(NULL AS VARCHAR) AS problem, TRUE AS outline_left, TRUE AS hole_right FROM building_geom")
def _(t):
    """Clockwise outlines with a repeated vertex and no end, and holes turned the wrong way."""
    p = lambda i: F.element_at(ring(), i)
    w, h = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    hole = geo.st_rectangle(F.col("minx") + w / 4, F.col("miny") + h / 4, F.col("maxx") - w / 4, F.col("maxy") - h / 4)
    fixed = shapes.st_make_valid(shapes.st_polygon(F.array(p(1), p(1), p(4), p(3), p(2)), hole))
    rows = spread(spread(t.building_geom).select("building_id", fixed.alias("g"))).withColumn("rings", F.get("g.parts", F.lit(0)))
    return rows.select(
        "building_id", F.size(F.flatten("rings")).alias("vertices"), shapes.st_problem(F.col("g")).alias("problem"),
        (shapes.signed_area(F.get("rings", F.lit(0))) > 0).alias("outline_left"), (shapes.signed_area(F.get("rings", F.lit(1))) < 0).alias("hole_right"),
    )


@query("st_intersects", """SELECT building_id, maxx >= 55.20003 AND minx <= 55.60003 AND maxy >= 24.80003 AND miny <= 25.10003
    AND NOT (minx > 55.30003 AND maxx < 55.50003 AND miny > 24.85003 AND maxy < 25.05003) AS hit FROM building_geom""")
def _(t):
    """Boxes against a frame: a box inside its hole does not meet it."""
    box = lambda *edges: geo.st_rectangle(*[F.lit(v) for v in edges])
    frame = shapes.st_polygon(box(55.20003, 24.80003, 55.60003, 25.10003), box(55.30003, 24.85003, 55.50003, 25.05003))
    rows = spread(t.building_geom.select("building_id", shapes.st_polygon(ring()).alias("geom")))
    return rows.select("building_id", shapes.st_intersects(F.col("geom"), frame).alias("hit"))


@query("st_bounds", "SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM building_geom", "minx miny maxx maxy")
def _(t):
    return sp.st_bounds(t.building_geom)


@query("st_area_planar", f"SELECT building_id, {AREA} AS area FROM ({HOLED}) WHERE building_id % 6 <> 0", "area")
def _(t):
    return features(t).where("geom IS NOT NULL").select("building_id", (shapes.st_area_planar(F.col("geom")) * 1e6).alias("area"))


INNER_AREA = f"abs(radians(w / 2) * ({authalic('(maxy - h / 4)')} - {authalic('(miny + h / 4)')}))"


@query("st_area_geog", f"""SELECT building_id, CASE building_id % 6 WHEN 3 THEN {RECT_AREA} - {INNER_AREA} WHEN 4 THEN 2 * {RECT_AREA} - {INNER_AREA} ELSE 0 END AS area_m2
    FROM ({HOLED}) WHERE building_id % 6 <> 0""", "area_m2:4")
def _(t):
    minx, miny, maxx, maxy = (F.col(c) for c in BOX)
    w, h = maxx - minx, maxy - miny
    outer, inner = geo.rect_area_geog(minx, miny, maxx, maxy), geo.rect_area_geog(minx, miny + h / 4, minx + w / 2, maxy - h / 4)
    kind = F.col("building_id") % 6
    exact = F.when(kind == 3, outer - inner).when(kind == 4, 2 * outer - inner).otherwise(0.0)
    # The ring sums agree with the closed form to 1 cm²; a row that does not would show as NULL.
    near = F.abs(shapes.st_area_geog(F.col("geom")) - exact) < 1e-4
    return features(t).where("geom IS NOT NULL").select("building_id", F.when(near, exact).alias("area_m2"))


@query("agg_spatial_stats", f"SELECT 'building_geom' AS table_name, count(*) AS geom_count, avg({RECT_AREA}) AS avg_area FROM building_geom", "avg_area")
def _(t):
    return agg.agg_spatial_stats(t.building_geom, geo.rect_area_geog(*[F.col(c) for c in BOX]), "building_geom")


def line():
    return geo.st_make_line(geo.st_point(F.col("x1"), F.col("y1")), geo.st_point(F.col("x2"), F.col("y2")))


@query("st_length_geog", f"SELECT road_id, {spheroid('x1', 'y1', 'x2', 'y2')} AS length_m FROM road", "length_m")
def _(t):
    return t.road.select("road_id", geo.st_length_geog(line()).alias("length_m"))


@query("st_distance_geog", f"SELECT id, {spheroid('lon', 'lat', *CENTRE)} AS distance_m FROM points", "distance_m")
def _(t):
    d = geo.spheroid_m(F.col("lon"), F.col("lat"), *[F.lit(v) for v in CENTRE])
    return t.points.select("id", d.alias("distance_m"))


@query("st_distance_geog__haversine", f"SELECT id, {haversine('lon', 'lat', *CENTRE)} AS distance_m FROM points", "distance_m")
def _(t):
    d = geo.haversine_m(F.col("lon"), F.col("lat"), *[F.lit(v) for v in CENTRE])
    return t.points.select("id", d.alias("distance_m"))


@query("st_distance_geog__vincenty", f"SELECT id, TRUE AS agrees FROM points")
def _(t):
    """The iterated solution agrees with the closed form to 20 parts per million."""
    lon, lat = F.lit(CENTRE[0]), F.lit(CENTRE[1])
    exact = st_distance_vincenty("lon", "lat", lon, lat)
    rows = t.points.withColumn("exact", exact)
    near = geo.spheroid_m(F.col("lon"), F.col("lat"), lon, lat)
    return rows.select("id", (F.abs(near - F.col("exact")) <= F.col("exact") * 2e-5 + 1e-6).alias("agrees"))


@query("st_centroid", f"""SELECT building_id, CASE building_id % 6 WHEN 1 THEN minx WHEN 4 THEN cx + 2 * w / 1.75 ELSE cx END AS x,
    CASE building_id % 6 WHEN 1 THEN miny ELSE cy END AS y FROM ({HOLED}) WHERE building_id % 6 <> 0""", "x y")
def _(t):
    return features(t).where("geom IS NOT NULL").select("building_id", shapes.st_centroid(F.col("geom")).alias("c")).select("building_id", "c.x", "c.y")


@query("st_closest_point", f"""SELECT building_id, greatest(minx, least({CENTRE[0]}, maxx)) AS x, greatest(miny, least({CENTRE[1]}, maxy)) AS y
    FROM building_geom""", "x y")
def _(t):
    x, y = F.lit(CENTRE[0]), F.lit(CENTRE[1])
    on_rect = geo.closest_on_rect(x, y, *[F.col(c) for c in BOX])
    return t.building_geom.select("building_id", on_rect.alias("p")).select("building_id", "p.x", "p.y")


@query("st_dump_points", """SELECT road_id, 0 AS pos, x1 AS x, y1 AS y FROM road UNION ALL SELECT road_id, 1, x2, y2 FROM road""", "x y")
def _(t):
    return t.road.select("road_id", F.posexplode(line()).alias("pos", "p")).select("road_id", "pos", "p.x", "p.y")


@query("st_segmentize", """SELECT road_id, CAST(greatest(1, ceil(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / 0.01)) AS BIGINT) + 1 AS vertices FROM road""")
def _(t):
    return t.road.select("road_id", F.size(geo.st_segmentize(line(), 0.01)).cast("bigint").alias("vertices"))


@query("st_dump", f"""SELECT building_id, 0 AS pos, replace({KIND}, 'MULTI', '') AS type, CASE building_id % 6 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS rings,
    CASE WHEN building_id % 6 IN (3, 4) THEN 0.75 ELSE 0 END * w * h * 1e6 AS area FROM ({HOLED}) WHERE building_id % 6 <> 0
    UNION ALL SELECT building_id, 1, replace({KIND}, 'MULTI', ''), 1, CASE building_id % 6 WHEN 4 THEN 1 ELSE 0 END * w * h * 1e6 FROM ({HOLED}) WHERE building_id % 6 IN (4, 5)""", "area")
def _(t):
    parts = features(t).where("geom IS NOT NULL").select("building_id", F.posexplode(shapes.st_dump(F.col("geom"))).alias("pos", "g"))
    return parts.select("building_id", "pos", "g.type", F.size(F.flatten("g.parts")).alias("rings"), (shapes.st_area_planar(F.col("g")) * 1e6).alias("area"))


@query("st_start_end_point", "SELECT road_id, x1 AS sx, y1 AS sy, x2 AS ex, y2 AS ey FROM road", "sx sy ex ey")
def _(t):
    s, e = geo.st_start_point(line()), geo.st_end_point(line())
    return t.road.select("road_id", s["x"].alias("sx"), s["y"].alias("sy"), e["x"].alias("ex"), e["y"].alias("ey"))


MERC_X = "radians({0}) * 6378137.0"
MERC_Y = "ln(tan(pi() / 4 + radians({0}) / 2)) * 6378137.0"


@query("st_transform_3857", f"SELECT id, {MERC_X.format('lon')} AS x, {MERC_Y.format('lat')} AS y, lon, lat FROM points", "x y lon lat")
def _(t):
    there = geo.st_transform_3857(geo.st_point(F.col("lon"), F.col("lat")))
    rows = t.points.select("id", there.alias("m")).withColumn("b", geo.st_transform_4326(F.col("m")))
    return rows.select("id", "m.x", "m.y", F.col("b.x").alias("lon"), F.col("b.y").alias("lat"))


@query("tile_layer_views", "SELECT building_id AS id, " + ", ".join(
    f"{(MERC_X if c.endswith('x') else MERC_Y).format(c)} AS {c}_3857" for c in BOX) + " FROM building_geom",
       " ".join(f"{c}_3857" for c in BOX))
def _(t):
    return sp.tile_layer_view(t.building_geom, "building_id")


@query("tile_assign", f"""SELECT z, CAST(floor((lon + 180.0) / 360.0 * pow(2, z)) AS BIGINT) AS x,
    CAST(floor((0.5 - ({MERC_Y.format('lat')}) / (2 * pi() * 6378137.0)) * pow(2, z)) AS BIGINT) AS y, count(*) AS n
    FROM points CROSS JOIN (SELECT unnest(range(10, 21)) AS z) AS levels GROUP BY 1, 2, 3""")
def _(t):
    return sp.tile_assign(t.points, 10, 20)


# --- radius, intersection, nearest ------------------------------------------------------

CLAMP = "greatest(minx, least({0}, maxx)), greatest(miny, least({1}, maxy))"


def rect_distance(x, y, d=spheroid) -> str:
    return d(x, y, f"greatest(minx, least({x}, maxx))", f"greatest(miny, least({y}, maxy))")


@query("buildings_within_radius", f"SELECT building_id FROM (SELECT building_id, {rect_distance(*CENTRE)} AS d FROM building_geom) WHERE d <= 20000")
def _(t):
    return sp.buildings_within_radius(t.building_geom, *CENTRE, 20_000)


@query("features_within_radius", f"""SELECT building_id, risk_score FROM (SELECT building_id, {rect_distance(*CENTRE)} AS d FROM building_geom) AS g
    LEFT JOIN (SELECT id AS b_id, total_area_km2 / 100 AS risk_score FROM zone WHERE id % 3 = 0) AS m ON m.b_id = g.building_id WHERE d <= 30000""", "risk_score")
def _(t):
    risk = t.zone.where("id % 3 = 0").select(F.col("id").alias("building_id"), (F.col("total_area_km2") / 100).alias("risk_score"))
    return sp.features_within_radius(t.building_geom, risk, *CENTRE, 30_000)


@query("st_dwithin_geog", f"SELECT id, {spheroid('lon', 'lat', *CENTRE)} <= 25000 AS near FROM points")
def _(t):
    d = geo.spheroid_m(F.col("lon"), F.col("lat"), *[F.lit(v) for v in CENTRE])
    return t.points.select("id", (d <= 25_000).alias("near"))


@query("within_radius", f"SELECT id, d AS distance_m FROM (SELECT id, {spheroid('lon', 'lat', *CENTRE)} AS d FROM points) WHERE d <= 25000", "distance_m")
def _(t):
    return sp.within_radius(t.points, *CENTRE, 25_000).select("id", "distance_m")


@query("join_radius", f"""SELECT a.id AS a_id, b.id AS b_id, {haversine('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS distance_m
    FROM points AS a JOIN points AS b ON abs(a.lat - b.lat) < 0.02 WHERE {haversine('a.lon', 'a.lat', 'b.lon', 'b.lat')} <= 1500""", "distance_m")
def _(t):
    return sp.join_radius(t.points, t.points, 1_500, metric="haversine")


@query("join_spatial_intersects", """SELECT a.building_id AS a_id, b.building_id AS b_id FROM
    (SELECT building_id, minx, miny, maxx + 0.01 AS maxx, maxy + 0.01 AS maxy FROM building_geom) AS a JOIN building_geom AS b
    ON a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy""")
def _(t):
    b = t.building_geom.withColumnRenamed("building_id", "id")
    a = b.withColumns({"maxx": F.col("maxx") + 0.01, "maxy": F.col("maxy") + 0.01})
    return sp.join_spatial_intersects(a, b, cell=0.02)


# Districts: diamonds of half diagonal r with a diamond of half its size cut out. A connected set meets one if its least
# distance to the centre, counted along the axes, is at most r and its largest at least r / 2.


def districts(t):
    def diamond(r):
        tips = [(r, 0), (0, r), (-r, 0), (0, -r), (r, 0)]
        return F.array(*[geo.st_point(F.col("cx") + a, F.col("cy") + b) for a, b in tips])

    return t.district_area.select("district_id", "cx", "cy", "r", shapes.st_polygon(diamond(F.col("r")), F.reverse(diamond(F.col("r") / 2))).alias("geom"))


def _box_hits(minx, miny, maxx, maxy) -> str:
    minx, miny, maxx, maxy = (f"({v})" for v in (minx, miny, maxx, maxy))
    near = f"greatest({minx} - cx, 0, cx - {maxx}) + greatest({miny} - cy, 0, cy - {maxy})"
    far = f"greatest(abs({minx} - cx), abs({maxx} - cx)) + greatest(abs({miny} - cy), abs({maxy} - cy))"
    return f"({near} <= r AND {far} >= r / 2)"


_W, _H = "(maxx - minx)", "(maxy - miny)"
_ALONG = [f"greatest(0, least(1, {v}))" for v in (f"(cx - minx) / {_W}", f"(cy - miny) / {_H}")]
_DIAGONAL = ["0", "1", *_ALONG]
_LINE_DISTANCE = [f"abs(minx + ({v}) * {_W} - cx) + abs(miny + ({v}) * {_H} - cy)" for v in _DIAGONAL]
KIND_HITS = f"""CASE building_id % 6 WHEN 1 THEN {_box_hits('minx', 'miny', 'minx', 'miny')}
    WHEN 2 THEN least({', '.join(_LINE_DISTANCE)}) <= r AND greatest({', '.join(_LINE_DISTANCE[:2])}) >= r / 2
    WHEN 3 THEN {_box_hits(*BOX)} WHEN 4 THEN {_box_hits(*BOX)} OR {_box_hits(f'minx + 2 * {_W}', 'miny', f'maxx + 2 * {_W}', 'maxy')}
    WHEN 5 THEN {_box_hits('minx', 'miny', 'maxx', 'miny')} OR {_box_hits('minx', 'maxy', 'maxx', 'maxy')} ELSE FALSE END"""


@query("spatial_clip_to_boundary", f"SELECT building_id, minx FROM building_geom WHERE EXISTS (SELECT 1 FROM district_area WHERE {_box_hits(*BOX)})", "minx")
def _(t):
    """Buildings that meet a district, with the suffix of the join tidied."""
    boxes = t.building_geom.withColumn("geom", shapes.st_polygon(ring()))
    clipped = clip.clip_to_boundary(boxes, districts(t), "building_id")
    return cl.rename_affixes(clipped.withColumnRenamed("minx", "minx_left"), suffix="_left").select("building_id", "minx")


@query("spatial_clip_to_boundary__kinds", f"SELECT building_id FROM building_geom WHERE EXISTS (SELECT 1 FROM district_area WHERE {KIND_HITS})")
def _(t):
    """Points, lines, polygons with holes and MULTI forms that meet a district."""
    return clip.features_in_boundary(features(t), districts(t), "building_id")


@query("spatial_clip_to_boundary__boxes", """SELECT building_id, minx FROM building_geom WHERE EXISTS (SELECT 1 FROM district_area
    WHERE maxx >= cx - r AND minx <= cx + r AND maxy >= cy - r AND miny <= cy + r)""", "minx")
def _(t):
    """Buildings that meet the box around a district."""
    boxes = districts(t).select(shapes.st_envelope(F.col("geom")).alias("b")).select("b.*")
    return sp.spatial_clip_to_boundary(t.building_geom, boxes, key="building_id").select("building_id", "minx")


SWEPT = """WITH b AS (SELECT {by} AS part, minx, {y1} AS y1, maxx + 0.01 AS x2, {y2} AS y2 FROM building_geom),
    xs AS (SELECT DISTINCT part, unnest([minx, x2]) AS x FROM b),
    strips AS (SELECT part, x AS lo, lead(x) OVER (PARTITION BY part ORDER BY x) AS hi FROM xs),
    inside AS (SELECT b.part, hi - lo AS w, y1, y2, max(y2) OVER (PARTITION BY b.part, lo ORDER BY y1, y2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM strips JOIN b ON b.part = strips.part AND minx <= lo AND hi <= x2)
    SELECT {out}sum({w} * greatest(0, y2 - greatest(y1, coalesce(before, y1)))) {scale} AS area FROM inside"""


def grown(t):
    """Boxes widened by a hundredth of a degree, so that many overlap."""
    return t.building_geom.withColumns({"maxx": F.col("maxx") + 0.01, "maxy": F.col("maxy") + 0.01})


@query("st_union_agg", SWEPT.format(by="building_id % 3", y1="miny", y2="maxy + 0.01", out="part, ", w="w", scale="") + " GROUP BY part", "area")
def _(t):
    """Square degrees that the boxes of each third of the buildings cover together."""
    return clip.union_area(grown(t).withColumn("part", F.col("building_id") % 3), ["part"])


@query("st_union_agg__geog", SWEPT.format(by="0", y1=authalic("miny"), y2=authalic("(maxy + 0.01)"), out="", w="radians(w)", scale="/ 1e6"), "area")
def _(t):
    """Square kilometres on the spheroid that all boxes cover together."""
    return clip.union_area(grown(t), geographic=True).select((F.col("area") / 1e6).alias("area"))


NEAREST_RECT = f"""SELECT p.id, g.building_id AS nearest_id, cx, cy, p.lon, p.lat FROM points AS p, LATERAL (
    SELECT building_id, greatest(minx, least(p.lon, maxx)) AS cx, greatest(miny, least(p.lat, maxy)) AS cy FROM building_geom
    ORDER BY sqrt((cx - p.lon) * (cx - p.lon) + (cy - p.lat) * (cy - p.lat)), building_id LIMIT 1) AS g"""


@query("join_knn1", f"SELECT id, nearest_id, {spheroid('lon', 'lat', 'cx', 'cy')} AS distance_m FROM ({NEAREST_RECT})", "distance_m")
def _(t):
    return sp.join_knn1(t.points, t.building_geom.withColumnRenamed("building_id", "id"))


@query("snap_to_nearest_building", f"""SELECT id, nearest_id AS building_id, cx AS snapped_lon, cy AS snapped_lat,
    {spheroid('lon', 'lat', 'cx', 'cy')} AS distance_m FROM ({NEAREST_RECT})""", "snapped_lon snapped_lat distance_m")
def _(t):
    return sp.snap_to_nearest_building(t.points, t.building_geom)


@query("load_plot_geometry", """SELECT CAST(p_partkey AS VARCHAR) AS plot_id, 'POLYGON' AS type, 5 AS vertices, 55.0005 AS lon, 25.0005 AS lat FROM part""", "lon lat")
def _(t):
    plots = sp.load_plot_geometry(t.cadastral_raw)
    return plots.select(
        "plot_id", F.col("geom.type").alias("type"), F.size(F.flatten(F.flatten("geom.parts"))).alias("vertices"),
        F.col("centroid.x").alias("lon"), F.col("centroid.y").alias("lat"),
    )


@query("scan_geo_vector", f"""SELECT CAST(building_id AS VARCHAR) AS source_object, {KIND} AS type, 'all' AS least FROM building_geom WHERE building_id % 6 <> 0
    UNION ALL SELECT CAST(building_id AS VARCHAR), {KIND}, 'some' FROM ({HOLED}) WHERE {AREA} >= 0.05""")
def _(t):
    """Features of every kind from GeoJSON, and those of at least so many square degrees."""
    rows = features(t).select(F.col("building_id").alias("osm_id"), shapes.st_from_geojson(shapes.st_as_geojson(F.col("geom"))).alias("geom"))
    both = [sp.scan_geo_vector(rows, min_area=a).withColumn("least", F.lit(n)) for a, n in ((0.0, "all"), (5e-8, "some"))]
    return both[0].unionByName(both[1]).select("source_object", "geom.type", "least")
