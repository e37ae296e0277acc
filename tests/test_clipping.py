import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terrawatt.functions import shapes
from terrawatt.operators.clipping import clip_to_boundary, features_in_boundary, union_area

SCHEMA = "id long, wkt string"


def geoms(spark, rows, name="wkt"):
    return spark.createDataFrame(rows, SCHEMA).select("id", shapes.st_geom_from_text(F.col(name)).alias("geom"))


def exact(parts):
    return [[[(Fraction(x), Fraction(y)) for x, y in r] for r in rings] for rings in parts]


def turn(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def on(a, b, p):
    return turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def cross(a, b, c, d):
    return (turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0) or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)


def sides(rings):
    return [(r[i], r[min(i + 1, len(r) - 1)]) for r in rings for i in range(max(1, len(r) - 1))]


def inside(p, rings):
    n = 0
    for a, b in sides(rings):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
            n += 1
    return n % 2 == 1


def meets(kind, part, polygon):
    if any(cross(a, b, c, d) for a, b in sides(part) for c, d in sides(polygon)) or inside(part[0][0], polygon):
        return True
    return "POLYGON" in kind and inside(polygon[0][0], part)


def text(kind, parts):
    row = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")"
    body = {
        "POINT": lambda: row(parts[0][0]), "LINESTRING": lambda: row(parts[0][0]), "POLYGON": lambda: "(" + ", ".join(map(row, parts[0])) + ")",
        "MULTIPOINT": lambda: "(" + ", ".join(row(p[0]) for p in parts) + ")", "MULTILINESTRING": lambda: "(" + ", ".join(row(p[0]) for p in parts) + ")",
        "MULTIPOLYGON": lambda: "(" + ", ".join("(" + ", ".join(map(row, p)) + ")" for p in parts) + ")",
    }
    return f"{kind} {body[kind]()}"


def star(rng, x, y, r, n, hole):
    """A star-shaped polygon on a coarse grid, so that shared corners and collinear edges occur."""
    import math

    ring = lambda s: [(round(x + s * r * k * math.cos(a), 2), round(y + s * r * k * math.sin(a), 2)) for a, k in angles]
    angles = [(2 * math.pi * i / n, rng.uniform(0.6, 1.0)) for i in range(n)]
    out = [ring(1.0)] + ([ring(0.5)] if hole else [])
    return [r + r[:1] for r in out]


@pytest.mark.parametrize("cell,rows_per_task", [(0.5, 1_000_000), (0.07, 7)])
def test_clip_like_brute_force(spark, cell, rows_per_task):
    rng = random.Random(5)
    at = lambda: (round(rng.uniform(-5, 5), 2), round(rng.uniform(-5, 5), 2))
    zones = [star(rng, *at(), rng.choice([0.05, 0.4, 1.5]), rng.choice([3, 5, 9]), k % 2) for k in range(8)]
    features = []
    for i in range(150):
        kind = ["POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON"][i % 6]
        many = 2 if kind.startswith("MULTI") else 1
        if kind.endswith("POINT"):
            parts = [[[rng.choice(rng.choice(zones)[0]) if i % 4 == 0 else at()]] for _ in range(many)]
        elif kind.endswith("LINESTRING"):
            parts = [[[at() if rng.random() < 0.3 else (a := at(), (round(a[0] + rng.uniform(-0.5, 0.5), 2), a[1]))[1] for _ in range(2)]] for _ in range(many)]
        else:
            parts = [star(rng, *at(), rng.choice([0.1, 0.3, 4.0 if i % 30 == 2 else 0.5]), 5, rng.random() < 0.5) for _ in range(many)]
        features.append((i, kind, parts))
    left = geoms(spark, [(i, text(kind, parts)) for i, kind, parts in features])
    right = geoms(spark, [(0, text("MULTIPOLYGON", zones[:3]))] + [(k, text("POLYGON", [z])) for k, z in enumerate(zones[2:])])
    want = {i for i, kind, parts in features if any(meets(kind, p, z) for p in exact(parts) for z in exact(zones))}
    assert 20 < len(want) < 140
    got = [r.id for r in features_in_boundary(left, right, cell=cell, rows_per_task=rows_per_task).collect()]
    assert sorted(got) == sorted(want)


def test_clip_defined_cases(spark):
    ring = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"
    rows = [
        (1, "POINT (2 2)"), (2, "POINT (1 2)"), (3, "POINT (4 4)"), (4, "POLYGON ((-1 -1, 9 -1, 9 9, -1 9, -1 -1))"),
        (5, "POLYGON ((-9 -9, 9 -9, 9 9, -9 9, -9 -9), (-1 -1, -1 5, 5 5, 5 -1, -1 -1))"), (6, "LINESTRING (1.5 1.5, 2.5 2.5)"),
        (7, "POLYGON EMPTY"), (8, None), (None, "POINT (0.5 0.5)"), (9, "POINT (0.5 0.5)"), (9, "POINT (8 8)"), (10, "MULTIPOINT ((8 8), (0 1))"),
    ]
    left = geoms(spark, rows).withColumn("key", F.lit(1)).withColumn("box", F.lit(2))
    got = clip_to_boundary(left, geoms(spark, [(1, ring), (2, ring), (3, None), (4, "POINT (2 2)")]))
    assert sorted(r.id for r in got.collect()) == [2, 3, 4, 9, 9, 10]
    assert got.columns == left.columns
    assert clip_to_boundary(left, geoms(spark, []).where("false")).collect() == []
    assert clip_to_boundary(left.where("false"), geoms(spark, [(1, ring)])).collect() == []


def brute_area(boxes):
    xs, ys = sorted({v for b in boxes for v in (b[0], b[2])}), sorted({v for b in boxes for v in (b[1], b[3])})
    return sum(
        (x2 - x1) * (y2 - y1)
        for x1, x2 in zip(xs, xs[1:]) for y1, y2 in zip(ys, ys[1:])
        if any(b[0] <= x1 and x2 <= b[2] and b[1] <= y1 and y2 <= b[3] for b in boxes)
    )


BOXES = "part string, minx double, miny double, maxx double, maxy double"


@pytest.mark.parametrize("per_cell,depth", [(32, 16), (2, 3), (1, 0)])
def test_union_area_like_brute_force(spark, per_cell, depth):
    rng = random.Random(2)
    rows = []
    for part in ("a", None):
        for _ in range(30):
            x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
            rows.append((part, x, y, x + rng.choice([0.05, 0.7]), y + rng.choice([0.05, 0.7])))
        rows += [(part, k / 100, k / 100, 1 - k / 100, 1 - k / 100) for k in range(20)] + rows[-3:]
    odd = [("flat", 0.0, 0.0, 0.0, 1.0), ("flat", None, 0.0, 1.0, 1.0), ("a", 5.0, 5.0, 4.0, 6.0)]
    boxes = spark.createDataFrame(rows + odd, BOXES).withColumn("n", F.lit(1)).withColumn("x1", F.lit(0))
    got = {r.part: r.area for r in union_area(boxes, ["part"], per_cell=per_cell, depth=depth).collect()}
    want = {p: brute_area([r[1:] for r in rows if r[0] == p]) for p in ("a", None)}
    assert got == pytest.approx({**want, "flat": 0.0})
    whole = union_area(boxes, per_cell=per_cell, depth=depth).collect()
    assert whole[0].area == pytest.approx(brute_area([r[1:] for r in rows]))


def test_union_area_of_nothing(spark):
    boxes = spark.createDataFrame([], BOXES)
    assert [r.area for r in union_area(boxes).collect()] == [0.0]
    assert union_area(boxes, ["part"]).collect() == []
