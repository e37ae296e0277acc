import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from terrawatt.llm.bpe import Encoder, bpe_digest, decode
from terrawatt.llm.queries import RANKS
from terrawatt.llm.textcore import class_table, slices
from terrawatt.llm.vocab_hash import Vocabulary, VocabHash, read_ranks


@pytest.fixture(scope="module")
def own():
    return Encoder(Vocabulary(read_ranks(RANKS)), class_table())


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, texts):
    ids, upto = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(upto, upto[1:], strict=False)]


def test_like_the_library_on_random_texts(own, library):
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", " ", "　", "é", "1", "²", "!", "#", "漢", "😀", "\x1c", "\x00", "'d", "ve", "R", "<|endoftext|>"]
    texts = ["", " ", "  ", "it's  fine\n\n x's't"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_is_classed_like_the_library(own, library):
    texts = [f"a{chr(c)}b1{chr(c)} {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0 or c in (0x1C89, 0x13460, 0x10D41))]
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_pre_token_and_repeats(own, library):
    texts = ["ab" * 5000, "x" * 9999, "ab" * 5000, " " * 3000 + "y"]
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    table = VocabHash(keys)
    assert sorted(table.index.tolist()) == list(range(len(keys)))
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys ^ np.uint64(1 << 40)) == -1).all()
    assert VocabHash(keys[:1]).find(keys[:2]).tolist() == [0, -1]
    assert VocabHash(keys[:0]).find(keys[:1]).tolist() == [-1]


def test_slices_cover_the_batch_once():
    batch = pa.record_batch([pa.array(["aaaa", None, "", "b" * 100, "c"])], names=["t"])
    assert [s.column(0).to_pylist() for s in slices(batch, "t", 5)] == [["aaaa", None, ""], ["b" * 100], ["c"]]


def test_digest_of_odd_rows(spark, library):
    rows = [(1, "x", None), (2, "x", ""), (3, "x", "Hello world's 漢"), (3, "x", "Hello world's 漢"), (None, "x", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, ids string, text string")
    got = bpe_digest(docs, RANKS, ids=True)
    for r in got.collect():
        text = {1: "", 2: "", 3: "Hello world's 漢", None: "a"}[r.doc_id]
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got.count() == 5
    assert {r.doc_id: bytes(r.bytes).decode() for r in decode(got, RANKS).collect()}[3] == "Hello world's 漢"
    assert bpe_digest(docs.where("false"), RANKS).collect() == []
