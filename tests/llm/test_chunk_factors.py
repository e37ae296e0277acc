from collections import Counter
from itertools import permutations
from re import findall

import numpy as np
import pyarrow as pa
import pytest

from terrawatt.llm import chunk_factors
from terrawatt.llm.chunk_factors import _finish_bucket, _fold_bucket, _term_blob, chunk_terms, source_divergence, tokenized
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.units import each_unit

SCHEMA = "doc_id long, text string, lang string, source string, unit long, term string, p int, value string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        v = len(kept)

        def rates(chosen, kept=kept, v=v):
            n = Counter(t for d in chosen for t in d[2] if t in kept)
            return n, {t: 1 + 1_000_000_000 * (n[t] + 1) // (sum(n.values()) + v) for t in kept}

        by = {s: rates([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        _, q = rates(mine)
        order = lambda items: sorted(items, key=lambda x: (-x[1], x[0].encode()))
        for s in by:
            pairs = [(o, sum((by[s][1][t] - by[o][1][t]) ** 2 // by[o][1][t] for t in kept)) for o in by if o != s]
            out |= {(lang, s, "pair", i, x, k + 1) for k, (i, x) in enumerate(order(pairs))}
            terms = [(t, (p - q[t]) ** 2 // q[t]) for t, p in by[s][1].items() if by[s][0][t] and p > q[t]]
            out |= {(lang, s, "term", i, x, k + 1) for k, (i, x) in enumerate(order(terms)[:top])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, s, 1, "a", 2, "b") for k, (t, lang, s) in enumerate(rows)], SCHEMA)


def made(n, seed):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "cat,", "cat", "dog-dog", "über", "Ünder", "x1y", "naïve.", "12", "--", "日本", "a b", "end"]
    seps = [" ", "  ", "\n", "\t", " \r\n", "\x0b"]
    text = lambda: "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.integers(0, 30)))
    return [(text(), rng.choice(["en", "de"]), f"s{rng.integers(0, 4)}") for _ in range(n)]


@pytest.mark.parametrize("pair_rows", [200_000, 3])
def test_like_brute_force(spark, pair_rows):
    rows = made(60, 1) + [(None, "en", "s0"), ("", "en", "only empty"), ("cat cat cat", None, None), ("cat", "", "z"), ("cat", None, "z"), ("lone", "it", "s1")] + made(60, 1)[:5]
    got = source_divergence(frame(spark, rows), pair_rows=pair_rows).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_small_units_ties_and_top(spark, monkeypatch):
    monkeypatch.setattr(chunk_factors, "UNIT_BYTES", 200)
    monkeypatch.setattr(chunk_factors, "PAIRS", 8)
    rows = made(80, 2)
    got = {tuple(r) for r in source_divergence(frame(spark, rows), least_docs=1, top=3).collect()}
    assert got == brute(rows, 1, 3)


def test_statistics_count_documents_and_occurrences(spark):
    rows = [("Word word, word-word other", "en", "a"), ("word", "en", "a"), ("other", "en", "b"), ("x" * 300_000 + " " + "word " * 70_000, "en", "b")]
    stats, groups = chunk_terms(frame(spark, rows), Scratch(spark, "test"))
    got = {(r.source, r.term[:9]): (r.n, r.docs) for r in stats.collect()}
    assert got == {("a", "word"): (5, 2), ("a", "other"): (1, 1), ("b", "other"): (1, 1), ("b", "word"): (70_000, 1), ("b", "x" * 9): (1, 1)}
    assert {tuple(r) for r in groups.collect()} == {("en", "a"), ("en", "b")}


def test_terms_of_chunks():
    chunks = [b"a-b", b"--", b"", b"x", "über'é".encode(), b"9a9"]
    got = tokenized(pa.array(chunks, pa.large_binary())).to_pylist()
    assert got == [[b"a", b"b"], [], [], [b"x"], ["über".encode(), "é".encode()], [b"a"]]


def test_sums_are_folded_as_they_arrive():
    held = pa.Table.from_pydict({"bucket": [4, 4], "stats": [_term_blob(pa.array([t.encode() for t in ts], pa.large_binary()), pa.array(["en"] * 2), pa.array(ss), np.array(n), np.array([1, 1])) for ts, ss, n in (("ab", "xx", [1, 2]), ("ba", "xy", [5, 7]))]})
    whole = _finish_bucket(2)(held).to_pylist()
    assert [tuple(r.values()) for r in whole] == [("en", "x", "a", 1, 1, 8), ("en", "y", "a", 7, 1, 8), ("en", "x", "b", 7, 2, 7)]
    calls = []
    run = each_unit(["bucket"], _finish_bucket(2), lambda t: calls.append(len(t)) or _fold_bucket(t), held_bytes=1)
    assert [r for b in run(iter(held.to_batches() + held.to_batches())) for r in b.to_pylist()][0]["n"] == 2 and calls


def test_empty_and_pairs_of_sources_without_terms(spark):
    assert source_divergence(frame(spark, [("a", "en", "b")]).where("false")).collect() == []
    got = {tuple(r) for r in source_divergence(frame(spark, [("", "en", "a"), (None, "en", "b"), ("rare", "en", "c")])).collect()}
    assert got == {("en", s, "pair", o, 0, k) for s in "abc" for k, o in enumerate(sorted(set("abc") - {s}), 1)} and list(permutations("abc", 2))
