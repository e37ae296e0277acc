import re
from collections import Counter

import numpy as np
import pytest

from terrawatt.llm import phrase_trees
from terrawatt.llm.phrase_trees import _distinct, _packed, _unpacked, collocations

SCHEMA = "doc_id long, text string, lang string, unit long, id int, code string, a int, score long, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, depth=4, cover=80, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for k in range(1, depth + 1):
                f.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    phrases = {x: n for x, n in f.items() if n >= least and len(x[1]) > 1}
    longest: dict = {}
    for (lang, p), n in phrases.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                x = (lang, p[i : i + k])
                longest[x] = max(longest.get(x, 0), n)
    out = {}
    for (lang, p), a in phrases.items():
        if 100 * longest.get((lang, p), 0) >= cover * a and (lang, p) in longest:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {
        (lang, i + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0])
        for lang, found in out.items() for i, x in enumerate(sorted(found)[:top])
    }


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, 1, 2, "c", 3, 4, "x") for k, (t, lang) in enumerate(rows)], SCHEMA)


def made(n, seed):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "new york", "new", "york", "city hall", "über", "a\xa0b", "日本", "x\x01y", "-", "data set is big", "no"]
    marks = [" ", " ", " ", "\t", ", ", ". ", "\n", "\x0c", "!"]
    text = lambda: "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.integers(0, 60)))
    return [(text(), rng.choice(["en", "de"])) for _ in range(n)]


def check(spark, rows, **args):
    got = [tuple(r) for r in collocations(frame(spark, rows), **args).collect()]
    args.pop("budget", None)
    assert set(got) == brute(rows, **args) and len(got) == len(set(got))
    return got


def test_like_brute_force(spark):
    rows = made(150, 1) + [(None, "en"), ("", None), ("the new the new", None), ("   ", "it")] + made(150, 1)[:20]
    assert len(check(spark, rows, least=5)) > 50


@pytest.mark.parametrize("budget", [7, 60])
def test_split_prefixes(spark, monkeypatch, budget):
    """Words, pairs and triples above the budget are split, down to a leaf that is above it itself."""
    monkeypatch.setattr(phrase_trees, "UNIT_BYTES", 2000)
    monkeypatch.setattr(phrase_trees, "MOST_SPLIT", 1 << 40)
    rows = made(80, 2) + [("one two three four five " * 40, "en"), ("one two three six one two seven", "en")] * 2
    check(spark, rows, least=3, budget=budget)


def test_depth_cover_top_and_ties(spark):
    rows = made(100, 3)
    check(spark, rows, least=4, depth=2)
    check(spark, rows, least=4, depth=3, cover=50, top=7)
    got = check(spark, [("b c . a b . c d", "x")] * 30, least=30)
    assert [r[1:3] for r in got] == [(1, "a b"), (2, "c d"), (3, "b c")]


def test_overlaps_long_texts_and_empty(spark):
    long = "la " * 50_000 + "w" * 200_000
    got = check(spark, [(long, "fr"), ("la la", "fr")])
    assert got[0][2:4] == ("la la la la", 49_997)
    assert collocations(frame(spark, [("a", "b")]).where("false")).collect() == []
    assert collocations(frame(spark, [("a b", "en"), (None, None)])).collect() == []
    with pytest.raises(ValueError):
        collocations(frame(spark, [("a", "b")]), depth=5)


def test_packed_columns_and_distinct_keys():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 2**32, 999).astype(np.uint64) for _ in range(5)]
    assert all((a == b).all() for a, b in zip(columns, _unpacked(_packed(columns), 5), strict=True))
    a, b, n = rng.integers(0, 5, 500), rng.integers(0, 5, 500), rng.integers(1, 9, 500)
    want = Counter()
    for x, y, z in zip(a.tolist(), b.tolist(), n.tolist(), strict=True):
        want[x, y] += z
    (x, y), total = _distinct(a, b, n=n)
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == sorted(want) and total.tolist() == [want[k] for k in sorted(want)]
    assert len(_distinct(a[:0], b[:0])[1]) == 0
