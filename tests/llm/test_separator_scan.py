import random

import numpy as np

from terrawatt.llm.queries import END_OF_DOCUMENT, RANKS, op2_byte_bpe
from terrawatt.llm.separator_scan import document_token_counts, read_flat_files, scan
from tests.harness import SF_DIR


def lengths(ids, separator=9):
    out, run = [], 0
    for i in ids:
        if i == separator:
            out.append(run)
            run = 0
        else:
            run += 1
    return out + [run] * (run > 0)


def streams(seed=2, n=40):
    rng = random.Random(seed)
    for f in range(n):
        ids = [rng.choice([9, 9, 9, 1, 2]) if rng.random() < 0.5 else rng.randint(1, 5) for _ in range(rng.randint(0, 60))]
        yield f, [i for i in ids if i != 9 or f % 3]


def test_blocks_cut_anywhere(spark):
    rng, rows, want = random.Random(4), [], []
    for f, ids in streams():
        want += [(f, k, n) for k, n in enumerate(lengths(ids))]
        raw, size = np.array(ids, "<u2"), rng.randint(1, 9)
        rows += [(f, k, bytearray(raw[i : i + size].tobytes())) for k, i in enumerate(range(0, len(raw), size))]
    rows.append((1000, 0, None))
    got = scan(spark.createDataFrame(rows, "file long, block long, data binary"), 9)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_raw_files(spark, tmp_path):
    want = {}
    for f, ids in streams(7, 6):
        np.array(ids, "<u2").tofile(tmp_path / f"part{f}.bin")
        want[f] = lengths(ids)
    got = scan(read_flat_files(spark, str(tmp_path), 10), 9).collect()
    for f, n in want.items():
        assert [r.n_tokens for r in sorted(got, key=lambda r: r.ordinal) if r.file.endswith(f"part{f}.bin")] == n


def test_same_counts_as_the_encoder(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in document_token_counts(docs, RANKS, END_OF_DOCUMENT, block_bytes=512).collect()}
    assert got == {r.doc_id: r.n_tokens for r in op2_byte_bpe(spark, SF_DIR).collect()}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a b", 1), (3, "a b", 1), (None, "x", 1), (4, "ab " * 20000, 1)], "doc_id long, text string, file int").coalesce(1)
    got = sorted(((r.doc_id, r.n_tokens) for r in document_token_counts(docs, RANKS, END_OF_DOCUMENT, block_bytes=64).collect()), key=str)
    assert [g for g in got if g[0] != 4] == sorted([(1, 0), (2, 0), (3, 2), (3, 2), (None, 1)], key=str)
    assert document_token_counts(docs.where("false"), RANKS, END_OF_DOCUMENT).collect() == []
