"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawatt.llm.shipping import ship, shipped
from terrawatt.llm.textcore import buffers, class_table, pretoken_starts, ragged, slices, tile
from terrawatt.llm.vocab_hash import Vocabulary, read_ranks

#: Merged pre-tokens that a task remembers before it starts afresh (tens of MB).
REMEMBERED = 400_000


def merge_bytes(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the adjacent pair of lowest rank, leftmost first, until none has a rank.

    Parts are a linked list over byte positions; a heap holds the mergeable pairs as (rank, start,
    end) packed into one integer, and stale ones are skipped, so a pre-token of n bytes takes
    O(n log n).
    """
    n, get, pop, push = len(word), rank.get, heapq.heappop, heapq.heappush
    width = n.bit_length()
    low = (1 << width) - 1
    after = list(range(1, n + 2))  # start of the next part = end of this one; 0 once merged away
    before = list(range(-1, n))
    heap = [r << 2 * width | i << width | i + 2 for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        top = pop(heap)
        end = top & low
        i = top >> width & low
        mid = after[i]
        if not mid or mid >= end or after[mid] != end:
            continue
        after[i], after[mid] = end, 0
        if end < n:
            before[end] = i
            far = after[end]
            r = get(word[i:far])
            if r is not None:
                push(heap, r << 2 * width | i << width | far)
        left = before[i]
        if left >= 0:
            r = get(word[left:end])
            if r is not None:
                push(heap, r << 2 * width | left << width | end)
    out, i = [], 0
    while i < n:
        end = after[i]
        out.append(rank[word[i:end]])
        i = end
    return out


class Encoder:
    """Ids of many texts at once. One instance serves one task."""

    def __init__(self, vocabulary: Vocabulary, classes: np.ndarray):
        self.vocabulary, self.classes = vocabulary, classes
        self.rank = {t: i for i, t in enumerate(vocabulary.tokens.to_pylist())}
        self.merged: dict[bytes, list[int]] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in them)."""
        data, offsets = buffers(texts)
        starts = pretoken_starts(data, offsets, self.classes)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        coded = tile(data, starts).dictionary_encode()
        distinct, codes = coded.dictionary, np.asarray(coded.indices)
        found = self.vocabulary.ids(distinct)
        lens = np.ones(len(found), np.int64)
        misses = np.flatnonzero(found < 0)
        pieces = []
        if misses.size:
            merged, rank = self.merged, self.rank
            if len(merged) > REMEMBERED:
                merged.clear()
            for word in distinct.take(pa.array(misses)).to_pylist():
                ids = merged.get(word)
                if ids is None:
                    ids = merge_bytes(word, rank)
                    if len(word) <= 64:
                        merged[word] = ids
                pieces.append(ids)
            lens[misses] = [len(p) for p in pieces]
        first = np.cumsum(lens) - lens
        flat = np.empty(int(lens.sum()), np.int32)
        flat[first[found >= 0]] = found[found >= 0]
        if misses.size:
            flat[ragged(first[misses], lens[misses])] = np.fromiter(itertools.chain.from_iterable(pieces), np.int32, int(lens[misses].sum()))
        ids = flat[ragged(first[codes], lens[codes])]
        upto = np.append(0, np.cumsum(lens[codes]))
        return ids, upto[np.searchsorted(starts, offsets)]


def tables(spark: SparkSession, ranks_path: str):
    """Broadcast of (vocabulary, code point classes): a few MB, fixed by the vocabulary file."""
    return ship(spark, (Vocabulary(read_ranks(ranks_path)), class_table()))


def bpe_digest(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256 and, with `ids`, the ids themselves.

    The text is encoded without special tokens and the ids are decoded again. A null text counts as
    empty: no tokens, and both digests are those of no bytes. Repeated rows each get a row; other
    columns of the input are ignored.
    """
    shared = tables(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, classes = shipped(shared)
        encoder = Encoder(vocabulary, classes)
        decimal = pa.array([b"%d " % i for i in range(len(vocabulary.tokens))], pa.large_binary())
        for batch in batches:
            for part in slices(batch, "text"):
                flat, upto = encoder.encode(part.column("text"))
                picked = pa.array(flat)
                columns = [part.column("id"), pa.array(np.diff(upto))]
                for table, trim in ((decimal, 1), (vocabulary.tokens, 0)):
                    data, offsets = buffers(table.take(picked))
                    view, at = memoryview(data), offsets[upto].tolist()
                    columns.append(pa.array([hashlib.sha256(view[a : max(a, b - trim)]).hexdigest() for a, b in zip(at, at[1:], strict=False)], pa.string()))
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), picked))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return slim.mapInArrow(run, schema)


def decode(docs: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """Adds the bytes that the ids stand for; null ids give null."""
    shared = tables(docs.sparkSession, ranks_path)

    @F.pandas_udf("binary")
    def joined(column):
        tokens = shipped(shared)[0].tokens.to_pylist()
        return column.map(lambda ids: None if ids is None else b"".join(tokens[i] for i in ids))

    return docs.withColumn(out_col, joined(F.col(ids_col)))
