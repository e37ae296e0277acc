"""Nearest lines and counts of neighbours against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from terrawatt.operators import crowding, nearest_lines
from terrawatt.operators.crowding import others_within
from terrawatt.operators.spatial import join_knn1, join_radius

LINE = "id long, x1 double, y1 double, x2 double, y2 double"


def brute(points, lines):
    out = []
    for i, x, y in points:
        best = []
        for n, x1, y1, x2, y2 in lines:
            dx, dy = x2 - x1, y2 - y1
            square = dx * dx + dy * dy
            u = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / square if square else 0.0))
            cx, cy = x1 + u * dx, y1 + u * dy
            best.append((((cx - x) * (cx - x) + (cy - y) * (cy - y)) ** 0.5, n))
        out.append((i, min(best)[1]))
    return sorted(out)


def nearest(spark, points, lines, **how):
    got = join_knn1(spark.createDataFrame(points, "id long, lon double, lat double"), spark.createDataFrame(lines, LINE), shape="segment", **how)
    return sorted((r.id, r.nearest_id) for r in got.collect())


def test_long_lines_are_not_cut(spark):
    """Lines of a million units would make fifty million pieces each."""
    r = random.Random(1)
    lines = [(i, *(r.uniform(0, 1e6) for _ in range(4))) for i in range(60)]
    points = [(i, r.uniform(-1e5, 1.1e6), r.uniform(0, 1e6)) for i in range(200)]
    assert nearest(spark, points, lines) == brute(points, lines)


@pytest.mark.parametrize("sample", [512, 1])
def test_small_tiles_and_chunks(spark, monkeypatch, sample):
    monkeypatch.setattr(nearest_lines, "CHUNK_POINTS", 30)
    monkeypatch.setattr(nearest_lines, "CHUNK_LINES", 40)
    monkeypatch.setattr(nearest_lines, "_SAMPLE", sample)
    tiles = nearest_lines._tiles
    monkeypatch.setattr(nearest_lines, "_tiles", lambda rows, n, size: tiles(rows, n, 60))
    r = random.Random(2)
    # Short and long lines, a shared vertex, a point as a line, one crowded corner and a far one.
    lines = [(i, x := r.uniform(0, 1), y := r.uniform(0, 1), x + r.uniform(-1, 1) * k, y + r.uniform(-1, 1) * k) for i in range(300) for k in [10 ** r.uniform(-3, 0)]]
    lines += [(1000 + i, 0.5, 0.5, r.uniform(0, 1), r.uniform(0, 1)) for i in range(20)] + [(2000, 9.0, 9.0, 9.0, 9.0), (2001, 0.0, 0.0, 9.0, 9.0)]
    points = [(i, r.uniform(0, 1), r.uniform(0, 1)) for i in range(300)] + [(400 + i, r.uniform(0, 1e-3), r.uniform(0, 1e-3)) for i in range(200)]
    points += [(700, 0.5, 0.5), (701, 8.0, 9.0), (702, 30.0, -4.0), *[(800 + i, *lines[i][1:3]) for i in range(50)]]
    assert nearest(spark, points, lines) == brute(points, lines)


def test_missing_ids_and_places(spark):
    lines = [(None, 0.0, 0.0, 1.0, 0.0), (3, 0.0, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 1.0, 0.0), (1, None, 0.0, 1.0, 0.0), (5, 2.0, 0.0, 2.0, 1.0), (None, 2.0, 0.0, 2.0, 2.0)]
    points = [(1, 0.5, 0.1), (2, None, 0.1), (None, 0.1, 0.5), (4, 2.0, 0.5), (4, 2.0, 0.5)]
    got = join_knn1(spark.createDataFrame(points, "id long, lon double, lat double"), spark.createDataFrame(lines, LINE), shape="segment")
    assert sorted(map(tuple, got.select("id", "nearest_id").collect()), key=str) == [(1, 2), (4, None), (None, 3)]
    empty = join_knn1(spark.createDataFrame(points, "id long, lon double, lat double"), spark.createDataFrame([], LINE), shape="segment")
    assert empty.count() == 0


@pytest.mark.parametrize("metric, radius", [("spheroid", 40_000.0), ("haversine", 40_000.0), ("spheroid", 9e6)])
def test_counts_equal_the_pairs(spark, monkeypatch, metric, radius):
    monkeypatch.setattr(crowding, "CHUNK_PLACES", 50)
    tiles = crowding._tiles
    monkeypatch.setattr(crowding, "_tiles", lambda rows, n, size: tiles(rows, n, 60))
    r = random.Random(3)
    rows = [(i, r.uniform(-180, 180), r.choice([89.7, -89.9, 0.0]) + r.uniform(-0.1, 0.1)) for i in range(150)]
    rows += [(i % 250, r.choice([180, -180, 10]) + r.uniform(-0.5, 0.5), 45 + r.uniform(-0.5, 0.5)) for i in range(400)]
    rows += [(i, 20.0, 20.0) for i in range(60)] + [(None, 20.0, 20.0), (7, 20.0, 20.0), (8, None, 1.0)]
    rows = [row for row in rows if row[1] is None or -180 <= row[1] <= 180]
    points = spark.createDataFrame(rows, "id long, lon double, lat double")
    pairs = join_radius(points, points, radius, metric)
    if radius > 1e6:  # beyond what latitude bands hold: all pairs
        metres = crowding._metres
        known = [row for row in rows if None not in row]
        want = {}
        for i, x, y in known:
            n = sum(j != i and metres(x, y, u, v, metric) <= radius for j, u, v in known)
            want[i] = want.get(i, 0) + int(n)
        want = {k: v for k, v in want.items() if v}
    else:
        want = {row.a_id: row["count"] for row in pairs.where("a_id <> b_id").groupBy("a_id").count().collect()}
    assert {row.id: row.n for row in others_within(points, radius, metric).collect()} == want
