"""Minimal perfect hash over a fixed vocabulary of byte strings (hash and displace)."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from terrawatt.llm.textcore import buffers, mix, span_hash

_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which are their ids."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class VocabHash:
    """key -> index without stored keys in the hash itself: n keys take n slots.

    Keys fall into buckets of four on average; each bucket, largest first, gets the first
    displacement that sends its keys to free slots. Buckets of one key name their slot directly.
    """

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.n, self.buckets = n, n // 4 + 1
        home = ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        counts = np.bincount(home, minlength=self.buckets)
        ends = np.cumsum(counts)
        self.displace = np.zeros(self.buckets, np.int64)
        self.index = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        for b in np.argsort(-counts, kind="stable"):
            size = counts[b]
            if size < 2:
                break
            members = order[ends[b] - size : ends[b]]
            base = 0
            while True:
                tries = np.arange(base, base + 512, dtype=np.uint64)
                slots = (mix(keys[members][None, :] ^ (tries[:, None] * _STEP)) % np.uint64(n)).astype(np.int64)
                fits = free[slots].all(1)
                for i in np.flatnonzero(fits):
                    if len(set(slots[i])) == size:
                        break
                else:
                    base += 512
                    continue
                self.displace[b] = base + i
                self.index[slots[i]] = members
                free[slots[i]] = False
                break
        single = np.flatnonzero(counts == 1)
        rest = np.flatnonzero(free)[: len(single)]
        self.displace[single] = -rest - 1
        self.index[rest] = order[ends[single] - 1]
        self.keys = keys[self.index] if n else keys

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, or -1."""
        if not self.n:
            return np.full(len(keys), -1, np.int64)
        d = self.displace[((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)]
        slot = (mix(keys ^ (np.maximum(d, 0).astype(np.uint64) * _STEP)) % np.uint64(self.n)).astype(np.int64)
        slot = np.where(d < 0, -d - 1, slot)
        return np.where(self.keys[slot] == keys, self.index[slot], -1)


class Vocabulary:
    """Tokens by id, with a minimal perfect hash from bytes to id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.large_binary())
        data, offsets = buffers(self.tokens)
        keys = span_hash(data, offsets[:-1], np.diff(offsets))
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two tokens share a hash")
        self.hash = VocabHash(keys)

    def ids(self, spans: pa.Array) -> np.ndarray:
        """The id of each span that is a whole token, else -1; candidates are compared byte by byte."""
        data, offsets = buffers(spans)
        found = self.hash.find(span_hash(data, offsets[:-1], np.diff(offsets)))
        hit = np.flatnonzero(found >= 0)
        same = pc.equal(self.tokens.take(pa.array(found[hit])), spans.take(pa.array(hit)))
        found[hit[~np.asarray(same)]] = -1
        return found
