"""Geometry functions and spatial joins against brute force."""

import math
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrawatt.functions import geo, shapes
from terrawatt.functions.kernels import st_as_wkb, st_geom_from_wkb, vincenty_m
from terrawatt.operators import intervals as iv
from terrawatt.operators import spatial as sp

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ring(*points):
    return F.array(*[geo.st_point(F.lit(float(x)), F.lit(float(y))) for x, y in points])


SQUARE = ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))


def test_wkt_forms(spark):
    g = one(
        spark,
        p=shapes.st_geom_from_text(F.lit("POINT(1.5 -2)")),
        y=shapes.st_geom_from_text(F.lit("polygon ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))")),
        bad=shapes.st_geom_from_text(F.lit("CIRCLE(1 2)")),
        none=shapes.st_geom_from_text(F.lit(None).cast("string")),
    )
    assert g.p.type == "POINT" and (g.p.parts[0][0][0].x, g.p.parts[0][0][0].y) == (1.5, -2.0)
    assert g.y.type == "POLYGON" and [len(r) for r in g.y.parts[0]] == [4, 4]
    assert g.bad is None and g.none is None


def test_dump(spark):
    r = one(
        spark,
        m=shapes.st_dump(shapes.st_geom_from_text(F.lit("MULTILINESTRING((0 0, 1 1), (2 2, 3 3, 4 4))"))),
        p=shapes.st_dump(shapes.st_geom_from_text(F.lit("MULTIPOINT((0 0), (1 1))"))),
        s=shapes.st_dump(shapes.st_geom_from_text(F.lit("LINESTRING(0 0, 1 1)"))),
    )
    assert [(g.type, len(g.parts[0][0])) for g in r.m] == [("LINESTRING", 2), ("LINESTRING", 3)]
    assert [(g.type, g.parts[0][0][0].x) for g in r.p] == [("POINT", 0.0), ("POINT", 1.0)]
    assert [g.type for g in r.s] == ["LINESTRING"]


def test_wkb_polygon_and_bad_bytes(spark):
    pts = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    body = struct.pack("<BII I", 1, 3, 1, 4) + b"".join(struct.pack("<dd", *p) for p in pts)
    df = spark.createDataFrame([(bytearray(body),), (bytearray(b"\x01\x02"),), (None,)], "w binary")
    got = [r.g for r in df.select(st_geom_from_wkb("w").alias("g")).collect()]
    assert got[0].type == "POLYGON" and [(p.x, p.y) for p in got[0].parts[0][0]] == pts
    assert got[1] is None and got[2] is None


def test_validity(spark):
    r = one(
        spark,
        ok=geo.ring_problem(ring(*SQUARE)),
        unclosed=geo.ring_problem(ring(*SQUARE[:4])),
        short=geo.ring_problem(ring((0, 0), (1, 1), (0, 0))),
        bow=geo.ring_problem(ring((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))),
        nan=geo.ring_problem(ring((0, 0), (float("nan"), 0), (2, 2), (0, 0))),
    )
    assert (r.ok, r.unclosed, r.short, r.bow, r.nan) == (None, "not closed", "too few points", "self intersection", "not finite")


def test_measures(spark):
    r = one(
        spark,
        area=geo.st_area_planar(ring(*SQUARE)),
        c=geo.st_centroid(ring((0, 0), (3, 0), (0, 3), (0, 0))),
        inside=geo.point_in_ring(F.lit(1.0), F.lit(1.0), ring(*SQUARE)),
        outside=geo.point_in_ring(F.lit(3.0), F.lit(1.0), ring(*SQUARE)),
        touch=geo.polygons_intersect(ring(*SQUARE), ring((1, 1), (5, 1), (5, 5), (1, 5), (1, 1))),
        nested=geo.polygons_intersect(ring(*SQUARE), ring((0.5, 0.5), (1, 0.5), (1, 1), (0.5, 0.5))),
        apart=geo.polygons_intersect(ring(*SQUARE), ring((3, 3), (4, 3), (4, 4), (3, 3))),
        near=geo.st_closest_point(F.lit(1.0), F.lit(5.0), ring(*SQUARE)),
        dense=F.size(geo.st_segmentize(ring((0, 0), (1, 0)), 0.3)),
    )
    assert r.area == 4.0 and (round(r.c.x, 9), round(r.c.y, 9)) == (1.0, 1.0)
    assert r.inside and not r.outside and r.touch and r.nested and not r.apart
    assert (r.near.x, r.near.y) == (1.0, 2.0) and r.dense == 5


def test_whole_earth_area(spark):
    r = one(spark, a=geo.rect_area_geog(*[F.lit(float(v)) for v in (-180, -90, 180, 90)]))
    assert abs(r.a / 510065621724089 - 1) < 1e-9


def test_vincenty_known_and_lambert_close(spark):
    # Meridian quarter and one degree of the equator.
    assert abs(vincenty_m([0.0], [0.0], [0.0], [90.0])[0] - 10001965.729) < 0.01
    assert abs(vincenty_m([0.0], [0.0], [1.0], [0.0])[0] - 111319.4908) < 0.001
    pairs = [(55.0, 25.0, 55.001, 25.001), (55.0, 25.0, 56.0, 26.0), (-73.9, 40.7, 2.35, 48.85), (10.0, -60.0, 11.0, -61.5)]
    for a in pairs:
        exact = float(vincenty_m(*[[v] for v in a])[0])
        near = one(spark, d=geo.spheroid_m(*[F.lit(v) for v in a])).d
        assert abs(near - exact) <= exact * 2e-5


def test_mercator_round_trip(spark):
    m = geo.st_transform_3857(geo.st_point(F.lit(55.3), F.lit(25.2)))
    r = one(spark, m=m, b=geo.st_transform_4326(m))
    assert abs(r.m.x - 6155967.84) < 0.1 and abs(r.b.x - 55.3) < 1e-9 and abs(r.b.y - 25.2) < 1e-9


def test_geojson(spark):
    r = one(
        spark,
        p=shapes.st_from_geojson(F.lit('{"type":"Point","coordinates":[1,2]}')),
        y=shapes.st_from_geojson(F.lit('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}')),
    )
    assert r.p.type == "POINT" and r.p.parts[0][0][0].x == 1.0 and len(r.y.parts[0][0]) == 4


coord = st.tuples(st.integers(0, 400), st.integers(0, 300))


def frame(spark, pts):
    return spark.createDataFrame([(i, 55 + x / 1000, 25 + y / 1000) for i, (x, y) in enumerate(pts)], "id int, lon double, lat double")


def haversine(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * geo.EARTH_RADIUS * math.asin(min(1, math.sqrt(h)))


@QUICK
@given(st.lists(coord, min_size=1, max_size=15), st.lists(coord, min_size=1, max_size=15))
def test_knn_equals_brute_force(spark, a, b):
    got = {r.id: r.nearest_id for r in sp.join_knn1(frame(spark, a), frame(spark, b), cell=0.01, shape="point").collect()}
    best = lambda p: min(((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2, j) for j, q in enumerate(b))
    d2 = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
    assert set(got) == set(range(len(a)))
    for i, p in enumerate(a):
        # Rounded coordinates may break exact ties either way; the distance must be the least.
        assert d2(p, b[got[i]]) == best(p)[0]


def test_knn_far_cluster_and_tie(spark):
    points = spark.createDataFrame([(1, -170.0, -60.0), (2, 10.0, 10.0)], "id int, lon double, lat double")
    geoms = spark.createDataFrame([(9, 10.0, 11.0), (4, 10.0, 9.0), (5, 10.0, 9.0), (7, 60.0, 60.0)], "id int, lon double, lat double")
    got = {r.id: r.nearest_id for r in sp.join_knn1(points, geoms, cell=0.05, shape="point").collect()}
    assert got[2] == 4 and got[1] == 4


@QUICK
@given(st.lists(coord, min_size=1, max_size=20))
def test_radius_equals_brute_force(spark, pts):
    df = frame(spark, pts)
    got = {(r.a_id, r.b_id) for r in sp.join_radius(df, df, 5000, "haversine", rows_per_task=10).collect()}
    p = [(55 + x / 1000, 25 + y / 1000) for x, y in pts]
    assert got == {(i, j) for i in range(len(p)) for j in range(len(p)) if haversine(p[i], p[j]) <= 5000}


def test_radius_antimeridian_and_pole(spark):
    df = spark.createDataFrame(
        [(1, 179.999, 10.0), (2, -179.999, 10.0), (3, 0.0, 89.999), (4, 180.0, 89.999)], "id int, lon double, lat double"
    )
    got = {(r.a_id, r.b_id) for r in sp.join_radius(df, df, 1000, "haversine").where("a_id < b_id").collect()}
    assert got == {(1, 2), (3, 4)}


@QUICK
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90), st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=12))
def test_intersects_equals_brute_force(spark, boxes):
    data = [(i, x / 10, y / 10, (x + w) / 10, (y + h) / 10) for i, (x, y, w, h) in enumerate(boxes)]
    df = spark.createDataFrame(data, "id int, minx double, miny double, maxx double, maxy double")
    got = sorted((r.a_id, r.b_id) for r in sp.join_spatial_intersects(df, df, cell=1.0, rows_per_task=5).collect())
    want = sorted(
        (a[0], b[0]) for a in data for b in data if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    )
    assert got == want


def test_geo_vector_filters(spark, rows):
    big, small = ring(*SQUARE), ring((0, 0), (0.001, 0), (0.001, 0.001), (0, 0))
    geom = shapes.st_polygon
    base = spark.range(1)
    df = base.select(F.lit("1").alias("osm_id"), geom(big).alias("geom")).unionByName(
        base.select(F.lit("2").alias("osm_id"), geom(small).alias("geom"))
    ).unionByName(base.select(F.lit(None).cast("string").alias("osm_id"), geom(big).alias("geom")))
    assert [r.source_object for r in sp.scan_geo_vector(df, min_area=0.1).collect()] == ["1"]


def test_radius_over_the_date_line_and_the_pole(spark):
    points = spark.createDataFrame([(1, -179.95, 0.0), (2, 179.9, 0.0), (3, 0.0, 0.0), (4, 180.0, 89.95)], "id int, lon double, lat double")
    ids = lambda df, c: sorted(r[c] for r in df.collect())
    assert ids(sp.within_radius(points, 179.99, 0.0, 20_000), "id") == [1, 2]
    assert ids(sp.within_radius(points, 0.0, 89.95, 20_000), "id") == [4]
    boxes = spark.createDataFrame([(1, -179.96, -0.01, -179.95, 0.01), (2, 10.0, 0.0, 11.0, 1.0)], "building_id int, minx double, miny double, maxx double, maxy double")
    assert ids(sp.buildings_within_radius(boxes, 179.99, 0.0, 20_000), "building_id") == [1]


def test_open_ends_meet_far_ranges(spark):
    rows = [(1, 1, "2020-01-01", None), (1, 2, "2300-01-01", "2400-01-01"), (2, 3, "2300-01-01", "2400-01-01")]
    df = spark.createDataFrame(rows, "contract_id int, assignment_id int, s string, e string").selectExpr(
        "contract_id", "assignment_id", "CAST(s AS DATE) AS effective_from", "CAST(e AS DATE) AS effective_to"
    )
    for limit in (64, 0):
        got = iv.interval_overlap_check(df, strict=True, direct_limit=limit).collect()
        assert [(r.a_id, r.b_id) for r in got] == [(1, 2)]


TEXTS = [
    "POINT (1.0 2.0)", "MULTIPOINT ((1.0 2.0), (3.0 4.0))", "LINESTRING (0.0 0.0, 3.0 4.0)", "MULTILINESTRING ((0.0 0.0, 3.0 4.0), (5.0 5.0, 6.0 5.0, 6.0 7.0))",
    "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 4.0, 0.0 0.0), (1.0 1.0, 1.0 2.0, 2.0 2.0, 2.0 1.0, 1.0 1.0))",
    "MULTIPOLYGON (((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 4.0, 0.0 0.0), (1.0 1.0, 1.0 2.0, 2.0 2.0, 2.0 1.0, 1.0 1.0)), ((10.0 0.0, 12.0 0.0, 12.0 2.0, 10.0 2.0, 10.0 0.0)))",
    "POINT EMPTY", "MULTIPOLYGON EMPTY",
]


def test_every_kind_survives_text_json_and_bytes(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").withColumn("g", shapes.st_geom_from_text(F.col("t")))
    rows = df.select(
        "i", shapes.st_as_text(F.col("g")).alias("text"), shapes.st_as_text(st_geom_from_wkb(st_as_wkb("g"))).alias("bytes"),
        shapes.st_as_text(shapes.st_from_geojson(shapes.st_as_geojson(F.col("g")))).alias("json"),
    ).collect()
    assert {(r.text, r.bytes, r.json) for r in rows} == {(t, t, t) for t in TEXTS}


def test_other_text_is_no_geometry(spark):
    bad = ["", "POINT (1)", "POINT (1 2, 3 4)", "POINT (a b)", "LINESTRING 1 2", "GEOMETRYCOLLECTION (POINT (1 2))", "POLYGON ((0 0, 1 x, 1 1, 0 0))", None]
    df = spark.createDataFrame([(t,) for t in bad], "t string")
    assert [r.g for r in df.select(shapes.st_geom_from_text(F.col("t")).alias("g")).collect()] == [None] * len(bad)
    worse = ['{"type":"Point","coordinates":[1]}', '{"type":"Polygon","coordinates":[[[0,0],[1,null]]]}', '{"type":"Circle","coordinates":[1,2]}', '{"a":1}', "x", None]
    assert [r.g for r in spark.createDataFrame([(t,) for t in worse], "t string").select(shapes.st_from_geojson(F.col("t")).alias("g")).collect()] == [None] * len(worse)


def test_bytes_with_z_and_m(spark):
    def line(code, flags, wide, order="<"):
        sign = 1 if order == "<" else 0
        srid = struct.pack(order + "I", 4326) if flags & 0x20000000 else b""
        points = b"".join(struct.pack(order + f"{wide}d", i, i + 0.5, *range(wide - 2)) for i in range(3))
        return bytearray(struct.pack(order + "BI", sign, code | flags) + srid + struct.pack(order + "I", 3) + points)

    forms = [line(2, 0, 2), line(1002, 0, 3), line(2002, 0, 3, ">"), line(3002, 0, 4), line(2, 0x80000000, 3), line(2, 0x40000000, 3), line(2, 0xE0000000, 4, ">"), line(4002, 0, 4), line(2, 0, 2)[:-1]]
    inner = line(1002, 0, 3)
    forms.append(bytearray(struct.pack("<BII", 1, 1005, 2)) + inner + inner)
    got = [r.t for r in spark.createDataFrame([(b,) for b in forms], "w binary").select(shapes.st_as_text(st_geom_from_wkb("w")).alias("t")).collect()]
    plain = "(0.0 0.5, 1.0 1.5, 2.0 2.5)"
    assert got == ["LINESTRING " + plain] * 7 + [None, None, f"MULTILINESTRING ({plain}, {plain})"]


def test_parts_and_holes_count(spark):
    g = shapes.st_geom_from_text(F.lit(TEXTS[5]))
    r = one(
        spark, area=shapes.st_area_planar(g), c=shapes.st_centroid(g), box=shapes.st_envelope(g), n=shapes.st_num_parts(g), parts=shapes.st_dump(g), rings=shapes.st_dump_rings(g),
        inside=F.array(*[shapes.st_contains_point(g, F.lit(float(x)), F.lit(float(y))) for x, y in ((0.5, 0.5), (1.5, 1.5), (11, 1), (7, 1), (4, 2), (1, 1.5))]),
        geog=shapes.st_area_geog(g), outer=geo.rect_area_geog(*[F.lit(float(v)) for v in (0, 0, 4, 4)]), hole=geo.rect_area_geog(*[F.lit(float(v)) for v in (1, 1, 2, 2)]),
        beside=geo.rect_area_geog(*[F.lit(float(v)) for v in (10, 0, 12, 2)]), line=shapes.st_centroid(shapes.st_geom_from_text(F.lit("MULTILINESTRING ((0 0, 2 0), (0 4, 6 4))"))),
        flat=shapes.st_centroid(shapes.st_geom_from_text(F.lit("POLYGON ((0 0, 2 0, 0 0, 0 0))"))), none=shapes.st_centroid(shapes.st_geom_from_text(F.lit("POLYGON EMPTY"))),
        turned=shapes.st_area_planar(shapes.st_orient(g)), signs=F.transform(shapes.st_dump_rings(shapes.st_orient(g)), lambda x: F.signum(shapes.signed_area(x["line"]))),
    )
    assert r.area == 19.0 and r.n == 2 and [p.type for p in r.parts] == ["POLYGON"] * 2 and [len(p.parts[0]) for p in r.parts] == [2, 1]
    assert math.isclose(r.c.x, (16 * 2 - 1.5 + 4 * 11) / 19) and math.isclose(r.c.y, (16 * 2 - 1.5 + 4) / 19)
    assert tuple(r.box) == (0.0, 0.0, 12.0, 4.0) and [(x.part, x.ring) for x in r.rings] == [(0, 0), (0, 1), (1, 0)]
    assert r.inside == [True, False, True, False, False, False]
    assert math.isclose(r.geog, r.outer - r.hole + r.beside, rel_tol=1e-9)
    assert (r.line.x, r.line.y) == (2.5, 3.0) and (r.flat.x, r.flat.y) == (1.0, 0.0) and r.none is None
    assert r.turned == 19.0 and r.signs == [1.0, -1.0, 1.0]


def test_multi_features_are_kept(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), ("9", None)], "osm_id string, t string").select("osm_id", shapes.st_geom_from_text(F.col("t")).alias("geom"))
    assert sorted(r.source_object for r in sp.scan_geo_vector(df).collect()) == [str(i) for i in range(len(TEXTS))]
    assert sorted(r.source_object for r in sp.scan_geo_vector(df, min_area=15.5).collect()) == ["5"]
    assert sorted(r.source_object for r in sp.scan_geo_vector(df, min_area=15.0).collect()) == ["4", "5"]


def test_knn_where_nearly_all_points_share_a_cell(spark):
    """A dense place is split to its own depth: few geometries per leaf, and the result is that of brute force."""
    dense = [(i, 10 + (i * 7919 % 4001) * 1e-7, 20 + (i * 104729 % 4001) * 1e-7) for i in range(1800)]
    far = [(5000 + i, -170.0 + i * 17, -60.0 + i * 5) for i in range(20)]
    df = spark.createDataFrame(dense + far, "id long, lon double, lat double")
    geoms = df.where("id % 3 = 0").selectExpr("id", "lon + 3e-8 AS lon", "lat")
    rows = geoms.collect()
    got = {r.id: r.nearest_id for r in sp.join_knn1(df, geoms, shape="point", leaf_rows=8).collect()}
    for i, x, y in dense[::37] + far:
        least = min((math.hypot(r.lon - x, r.lat - y), r.id) for r in rows)
        hit = next(r for r in rows if r.id == got[i])
        assert math.hypot(hit.lon - x, hit.lat - y) <= least[0] * (1 + 1e-12)
    spots = df.select(F.lit("p").alias("side"), F.col("lon").alias("minx"), F.col("lat").alias("miny"), F.col("lon").alias("maxx"), F.col("lat").alias("maxy"))
    tree = sp._Quadtree(spots, 8)
    where = df.select(*tree.finest(F.col("lon"), F.col("lat"))).join(tree.leaf_of("p"), ["cx", "cy"]).groupBy("node").count().collect()
    assert sum(r["count"] for r in where) == len(dense) + len(far) and max(r["count"] for r in where) <= 8
    assert len({r.node.level for r in where}) > 1


def test_knn_long_lines_and_other_units(spark):
    lines = [(1, 0.0, 0.0, 900.0, 0.0), (2, 0.0, 5.0, 0.0, 700.0), (3, 100.0, 100.0, 100.5, 100.0), (4, 0.0, 0.0, None, 1.0)]
    geoms = spark.createDataFrame(lines, "id int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 450.0, 3.0), (2, 1.0, 400.0), (3, 101.0, 98.0), (4, -50.0, -50.0), (5, None, 1.0)], "id int, lon double, lat double")
    got = {r.id: r.nearest_id for r in sp.join_knn1(points, geoms, cell=7.0, shape="segment").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1}
    assert sp.join_knn1(points, geoms.where("false"), shape="segment").collect() == [] == sp.join_knn1(points.where("false"), geoms, shape="segment").collect()


def test_overlap_exists_without_pairs(spark):
    """Against all pairs: equal starts, touching ends, open ends, ranges within others and over many months."""
    import datetime as dt
    import random

    rng = random.Random(3)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    rows = []
    for k in range(120):
        at = 0
        for _ in range(rng.randint(0, 6)):
            at += rng.choice([0, 1, 5, 40, 400])
            length = rng.choice([0, 1, 4, 39, 300])
            rows.append((k, len(rows), day(at), None if rng.random() < 0.15 else day(at + length)))
            at += length + rng.choice([1, 1, 1, 0, -3])
    rows += [(None, 9000, day(0), day(9)), (None, 9001, day(0), day(9)), (500, 9002, None, day(3)), (500, 9003, day(1), day(2)), (501, 9004, day(9), day(1)), (501, 9005, day(0), day(20))]
    df = spark.createDataFrame(rows, "contract_id int, assignment_id int, effective_from date, effective_to date")
    for strict in (False, True):
        want = {}
        good = [r for r in rows if r[0] is not None and r[2] and (r[3] is None or r[3] >= r[2])]
        for a in good:
            for b in good:
                if a[0] == b[0] and a[1] != b[1] and a[2] >= b[2] and ((a[2] <= b[3]) if b[3] else strict):
                    want[a[0]] = min(want.get(a[0], a[2]), a[2])
        got = {r.contract_id: r.first_overlap for r in iv.interval_overlap_exists(df, strict=strict).collect()}
        assert got == want and len(want) > 20


def test_costly_expressions_run_on_all_cores(spark):
    """Features come from one small file, but their expressions take more than a task."""
    from terrawatt.plans.catalogue import geospatial
    from terrawatt.plans.registry import Inputs
    from tests.harness import SF_DIR

    cores = spark.sparkContext.defaultParallelism
    assert geospatial.features(Inputs(spark, SF_DIR)).rdd.getNumPartitions() >= cores


def test_radius_measures_few_of_the_pairs_that_meet(spark):
    """Pairs go by the chord before any distance is computed, without losing one at the border, wherever they lie."""
    df = frame(spark, [(x, y) for x in range(0, 60, 3) for y in range(0, 60, 3)])
    for metric in ("haversine", "spheroid"):
        pairs = sp.join_radius(df, df, 2000, metric)
        d = sp.METRIC[metric](F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat"))
        want = df.alias("a").crossJoin(df.alias("b")).where(d <= 2000).count()
        assert pairs.count() == want
    assert "_ax" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_intersects_with_finer_cells(spark):
    """Crowded cells are halved; the pairs stay the same, with one large box and incomplete ones among them."""
    x, y = (F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 500.0 for s in (1, 2))
    df = spark.range(4000).select("id", x.alias("minx"), y.alias("miny")).withColumns({"maxx": F.col("minx") + 0.05, "maxy": F.col("miny") + 0.04})
    odd = spark.createDataFrame([(5000, 0.0, 0.0, 2.0, 1.5), (5001, None, 0.0, 1.0, 1.0)], "id long, minx double, miny double, maxx double, maxy double")
    df = df.union(odd)
    a, b = df.alias("a"), df.alias("b")
    want = a.crossJoin(b).where("a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy").select("a.id", "b.id").collect()
    assert sp._halvings(df, df, 0.5) >= 1
    got = sp.join_spatial_intersects(df, df, cell=0.5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
