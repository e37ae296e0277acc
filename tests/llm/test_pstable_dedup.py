import numpy as np
import pytest

from terrawatt.llm.pstable_dedup import Hashing, near_vectors, unit_rows


def brute(rows):
    usable = {k: np.array(v, float) for k, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    root = {k: k for k, _ in rows}
    count = {k: 0 for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in usable:
        for b in usable:
            u, v = usable[a], usable[b]
            if a < b and len(u) == len(v) and u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= 0.9:
                count[a] += 1
                count[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (count[k], find(k), find(k) == k) for k, _ in rows}


def planted(n=25, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for centre in rng.normal(size=(4, dim)):
        for _ in range(n):
            v = centre + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([1, 2])]))
    return rows + [(1000 + i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(30, dim)))]


ODD = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0] * 15 + [None]), (2004, [float("nan")] + [1.0] * 15), (2005, [1.0, 2.0]), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [float("inf")] * 2)]


@pytest.mark.parametrize("kind,block", [("float", 1024), ("double", 8)])
def test_like_brute_force(spark, kind, block):
    rows = planted() + ODD
    vectors = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], f"vec_id long, embedding array<{kind}>, key int, id int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(vectors, block=block).collect()}
    assert got == brute(rows)


def test_repeats_nulls_and_empty(spark):
    """Every row is a vector of its own, whatever its id."""
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [0.0, 1.0]), (None, [-1.0, 0.0]), (None, [-1.0, 0.01]), (None, [0.0, -1.0]), (None, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(vectors).collect()), key=str)
    want = [(1, 3, 1, True)] * 2 + [(2, 3, 1, False), (None, 3, 1, False), (1, 1, 1, True), (3, 1, 1, False), (None, 1, None, True), (None, 1, None, False), (None, 0, None, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert near_vectors(vectors.where("false")).collect() == []


def test_keys_do_not_depend_on_the_batch():
    v, norms = unit_rows(np.random.default_rng(1).normal(size=(300, 64)))
    whole = Hashing().keys(v, norms)
    for at in (0, 17, 299):
        one, norm = unit_rows(v[at : at + 1])
        assert np.array_equal(Hashing().keys(one, norm)[0], whole[at])


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.normal(size=(2000, 64))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.905 * a + np.sqrt(1 - 0.905**2) * side
    met = (Hashing().keys(*unit_rows(a)) == Hashing().keys(*unit_rows(b))).any(1)
    assert met.mean() > 0.98
