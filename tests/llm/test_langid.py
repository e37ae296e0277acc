import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from terrawatt.llm import langid
from terrawatt.llm.langid import Pieces, Words, expected_counts, forward, identify, normalised
from terrawatt.llm.queries import RANKS, language_training, op9_language_id
from terrawatt.llm.textcore import class_table
from terrawatt.llm.vocab_hash import read_ranks
from tests.harness import SF_DIR


def model(pieces, langs=1):
    return normalised(np.repeat((4.0**-pieces.lens)[:, None], langs, 1) * 1e6, pieces.lens)


def test_forward_sums_all_segmentations():
    pieces = Pieces(RANKS)
    probs = model(pieces)
    known = {t: i for i, t in enumerate(sorted({t for t in read_ranks(RANKS) if 0 < len(t) <= 7} | {bytes([b]) for b in range(256)}))}

    def ways(word, at=0):
        if at == len(word):
            return 1.0
        return sum(probs[known[word[at : at + n]], 0] * ways(word, at + n) for n in range(1, 8) if word[at : at + n] in known)

    words = [b" the", b"thing", "été".encode(), b"a", b"on.\x00"]
    assert np.allclose(forward(pa.array(words, pa.large_binary()), pieces, probs)[:, 0], [np.log(ways(w)) for w in words])


def test_expected_counts_cover_every_byte():
    pieces = Pieces(RANKS)
    words = [b" the", b"tion" * 30, b"x"]
    got = expected_counts(pa.array(words, pa.large_binary()), np.zeros(3, int), np.array([2.0, 1.0, 5.0]), pieces, model(pieces))
    assert np.isclose((got[:, 0] * pieces.lens).sum(), 2 * 4 + 120 + 5)


def test_words_keep_letters_only_and_their_document():
    words = Words(pa.array(["Ab ab 12", None, "", "!! Été"], pa.string()), class_table())
    assert words.doc.tolist() == [0, 0, 3]
    assert [bytes(w) for w in words.distinct.take(pa.array(words.codes)).to_pylist()] == [b"ab", b" ab", " été".encode()]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = op9_language_id(spark, SF_DIR).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_empty_training(spark):
    rows = [(1, None, "en", 0.1), (2, "", "en", 0.1), (3, "12 34 !!", "en", 0.1), (4, "the and of", None, 0.1), (5, "the thing and that", "en", 0.1), (5, "the thing and that", "en", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = sorted((r.doc_id, r.lang_pred) for r in identify(docs, language_training(docs), RANKS).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (5, "en")]
    assert {r.lang_pred for r in identify(docs, language_training(docs.where("false")), RANKS).collect()} == {"und"}
    assert identify(docs.where("false"), language_training(docs), RANKS).count() == 0


def test_long_pieces_and_long_words_count_whole():
    pieces = Pieces(RANKS)
    tokens = set(read_ranks(RANKS)) - {b""}
    short = sorted({t for t in tokens if len(t) <= 7} | {bytes([b]) for b in range(256)})
    known = {t: i for i, t in enumerate(short + sorted(t for t in tokens if len(t) > 7))}
    rng = np.random.default_rng(3)
    probs = normalised(rng.uniform(0.1, 1, (pieces.n, 2)), pieces.lens)

    def ways(word):
        sums = [np.ones(2)] + [np.zeros(2) for _ in word]
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                if word[i:j] in known:
                    sums[j] = sums[j] + sums[i] * probs[known[word[i:j]]]
        return np.log(sums[-1])

    words = [b" because", b" international" * 5, "ж".encode() * 30, "国际".encode() * 9, b" because", b"understanding" * 4]
    assert np.allclose(forward(pa.array(words, pa.large_binary()), pieces, probs), [ways(w) for w in words])
    got = expected_counts(pa.array(words, pa.large_binary()), np.array([0, 1, 0, 1, 0, 1]), np.ones(6), pieces, probs)
    assert np.isclose((got.sum(1) * pieces.lens).sum(), sum(map(len, words))) and got[known[b" because"], 0] > 0
    assert np.isfinite(forward(pa.array([b"x" * 3000], pa.large_binary()), pieces, probs)).all()


@pytest.mark.parametrize("stretch", [40, 1 << 14])
def test_walks_equal_the_grid(monkeypatch, stretch):
    """Long pre-tokens, walked in stretches, have the sums and the expected uses of the whole matrix."""
    pieces = Pieces(RANKS)
    rng = np.random.default_rng(7)
    probs = normalised(rng.uniform(0.1, 1, (pieces.n, 2)), pieces.lens)
    letters = np.frombuffer(b"etaoinshr", np.uint8)
    words = [b" because", b"international" * 40, rng.choice(letters, 700).tobytes(), "国际".encode() * 60, bytes(rng.integers(0, 256, 300, dtype=np.uint8)), b"-" * 333, b" " * 257]
    array, langs, counts = pa.array(words, pa.large_binary()), np.array([0, 1, 0, 1, 1, 0, 0]), np.arange(1.0, 8.0)
    monkeypatch.setattr(langid, "LONG_BYTES", 10_000)
    want, uses = forward(array, pieces, probs), expected_counts(array, langs, counts, pieces, probs)
    monkeypatch.setattr(langid, "LONG_BYTES", 5)
    monkeypatch.setattr(langid, "WALK_BYTES", stretch)
    assert np.allclose(forward(array, pieces, probs), want, rtol=1e-12)
    assert np.allclose(expected_counts(array, langs, counts, pieces, probs), uses, rtol=1e-9, atol=1e-12)


def test_a_megabyte_without_spaces():
    pieces = Pieces(RANKS)
    probs = model(pieces, 4)
    word = np.random.default_rng(8).choice(np.frombuffer(b"ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/", np.uint8), 1_000_000).tobytes()
    tracemalloc.start()
    start = time.perf_counter()
    got = forward(pa.array([word], pa.large_binary()), pieces, probs)
    took, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(got).all() and took < 120 and peak < 200e6
