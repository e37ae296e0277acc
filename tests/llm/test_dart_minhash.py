import collections
import random

import numpy as np
import pyarrow as pa

from terrawatt.llm import dart_minhash
from terrawatt.llm.components import components
from terrawatt.llm.dart_minhash import BANDS, ROWS, coded_sets, dart_signature, elements, near_duplicates
from terrawatt.llm.textcore import mix


def test_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(7)
    z = []
    for t in range(40):
        h = mix(np.arange(200, dtype=np.uint64) + np.uint64(1000 * t))
        a = rng.integers(0, 6, 200).astype(float) * rng.choice([1, 0.5])
        b = np.where(rng.random(200) < 0.8, a, rng.integers(0, 6, 200))
        b[:20] *= 1.7
        similarity = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        doc = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = dart_signature(doc, np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 2000)
        z.append(((s[0] == s[1]).mean() - similarity) / np.sqrt(similarity * (1 - similarity) / 2000))
    assert abs(np.mean(z)) < 0.5 and np.std(z) < 1.5


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g", "one", None, "x y " * 500, "a b c d e f g"]
    doc, shingle, weight, n = elements(pa.array(texts, pa.string()))
    whole = dart_signature(doc, shingle, weight, n, 30)
    for i, t in enumerate(texts):
        d, s, w, m = elements(pa.array([t], pa.string()))
        assert np.array_equal(dart_signature(d, s, w, m, 30)[0], whole[i])
    assert (whole[0] == whole[4]).all() and not whole[2].any() and whole[1].all()


def words(text):
    for mark in ".,;:!?\"'()":
        text = text.replace(mark, " ")
    return text.lower().split()


def brute(rows, threshold=0.8):
    """Component of each (id, text) by comparing all pairs."""
    bags = {}
    for k, text in rows:
        w = words(text or "")
        n = min(5, len(w))
        bags[k] = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else None
    root = {k: k for k in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(bags)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) >= threshold * sum((bags[a] | bags[b]).values()):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def crowd(seed=5, base=3, copies=60, length=120, edits=5):
    """Near copies around a few texts, whose mutual similarity lies on both sides of the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for b in range(base):
        text = rng.choices(vocabulary, k=length)
        for _ in range(copies):
            mine = list(text)
            for _ in range(rng.randint(0, edits)):
                mine[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(mine)))
    rng.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


def check(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs, **more).collect()}
    want = brute(rows)
    assert got == {k: (c, k == c) for k, c in want.items()}


def test_like_brute_force_on_crowds(spark):
    check(spark, crowd())


def test_like_brute_force_with_tiny_blocks(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK_ROWS", 7)
    check(spark, crowd(seed=9, base=1, copies=50, edits=7))


def test_odd_rows(spark):
    long = " ".join(f"t{i % 977}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " .,! "), (4, "One."), (5, "one"), (6, "a b c"), (7, "A b, C!"), (8, long), (9, long + " end"), (10, "a a a a a a a a a a a"), (11, "a a a a a")]
    check(spark, rows)
    docs = spark.createDataFrame([(1, "x y z", 0, 0), (1, "x y z", 0, 0), (None, "x y z", 0, 0), (0, "x y z", 0, 0)], "doc_id long, text string, id int, key int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 0, False), (1, 0, False), (0, 0, True), (None, 0, False)], key=str)
    assert near_duplicates(docs.where("false")).collect() == []


def test_rows_of_one_id_or_none_are_judged_by_their_own_text(spark):
    rng = random.Random(2)
    a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(300)], k=100)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, c), (None, c), (None, c + " more"), (None, "other words")]
    docs = spark.createDataFrame([(*r, 10 + i) for i, r in enumerate(rows)], "doc_id long, text string, key long")
    got = {r.key: (r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs, key_col="key").collect()}
    assert got == {
        10: (1, 1, True), 11: (1, 1, True), 12: (2, 1, False), 13: (3, 1, False),
        14: (None, None, True), 15: (None, None, False), 16: (None, None, False), 17: (None, None, True),
    }


def test_codes_stand_for_counts(spark):
    docs = spark.createDataFrame([(1, "a a a a a a a"), (2, None)], "id long, text string")
    got = {r.id: len(set(r.codes)) for r in coded_sets(docs).collect()}
    assert got == {1: 3, 2: 0} and BANDS * ROWS == 150


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(30)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(31)}}
