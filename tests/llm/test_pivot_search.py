import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawatt.llm.pivot_search import farthest, nearest, pivot_distances, score_bound

SCHEMA = "vec_id long, embedding array<float>, label int, id int, block string, score long, class int, rank int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(k, v, 0, 1, "b", 2, 3, 4) for k, v in rows], SCHEMA.replace("<float>", f"<{kind}>"))


def brute(rows, asks, k):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in usable if asks(i)}:
        for v in {tuple(v) for i, v in usable if i == q}:
            scores = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in usable if i != q and len(c) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def made(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    v = [centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.02, 0.4]) for _ in range(n)]
    rows = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]
    return rows + [(n + i, rows[i % 3][1]) for i in range(copies)]


@pytest.mark.parametrize("args", [{}, {"block": 4, "queries_at_once": 2, "tile": 3, "pivots": 3, "k": 2}])
def test_like_brute_force(spark, args):
    rows = made(160, 8, 1, copies=60)
    got = sorted(tuple(r) for r in nearest(frame(spark, rows), F.col("vec_id") % 5 == 0, **args).collect())
    assert got == brute(rows, lambda i: i % 5 == 0, args.get("k", 5))


def test_odd_vectors_ties_and_repeats(spark):
    odd = [(200, None), (205, []), (210, []), (215, [0.0] * 8), (220, [1.0] * 7 + [None]), (225, [float("nan")] * 8), (230, [float("inf")] + [1.0] * 7), (235, [1.0, 2.0]), (240, [-1.0, 2.0]), (245, [3.0]), (None, [1.0] * 8)]
    rows = made(40, 8, 2) + odd + [(5, [1.0, 1.0]), (300, [0.5, -0.25]), (301, [0.5, -0.25]), (302, [2.0, 0.0]), (303, [0.0, 1.0])]
    got = sorted(tuple(r) for r in nearest(frame(spark, rows), F.col("vec_id") % 5 == 0, block=3).collect())
    assert got == brute(rows, lambda i: i % 5 == 0, 5)


def test_all_equal_and_empty(spark):
    rows = [(i, [0.5, 0.25]) for i in range(30)]
    got = sorted(tuple(r) for r in nearest(frame(spark, rows), F.col("vec_id") % 10 == 0).collect())
    assert got == brute(rows, lambda i: i % 10 == 0, 5)
    repeated = nearest(frame(spark, [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in repeated] == [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 2, 65536)]
    assert nearest(frame(spark, rows).where("false"), F.col("vec_id") == 0).collect() == []
    assert nearest(frame(spark, rows[:1]), F.col("vec_id") == 0).collect() == []
    with pytest.raises(Exception, match="too long"):
        nearest(frame(spark, [(0, [1e30, 1.0])], "double"), F.col("vec_id") == 0).collect()


def test_bounds_hold_and_leave_out_most_of_clustered_vectors():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.05))
    pivots = farthest(x[:500], 32)
    assert len(np.unique(pivots, axis=0)) == len(pivots) == 32
    far, norm = pivot_distances(x, pivots), (x * x).sum(1)
    for q in range(20):
        bound, score = score_bound(norm[q], norm, np.abs(far - far[q]).max(1)), x @ x[q]
        assert (bound >= score).all()
        assert (bound >= np.sort(score)[-6]).mean() < 0.2
