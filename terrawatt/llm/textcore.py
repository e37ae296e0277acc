"""Vectorised kernels over the UTF-8 bytes of Arrow string batches.

A batch of texts is one byte buffer with offsets. Words, lines and pre-tokens are spans of that
buffer found by comparing neighbouring bytes, so that no Python object is made per word.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one kernel call works on; the temporaries are about twenty times as large.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# Code points that Unicode 16 classifies as letters or numbers and 15.1 leaves unassigned.
UNICODE_16_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
UNICODE_16_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3


def class_table() -> np.ndarray:
    """Class of every code point: letter, number, white space or other (about 1 MB)."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for ranges, kind in ((UNICODE_16_LETTERS, LETTER), (UNICODE_16_NUMBERS, NUMBER)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[list(WHITE_SPACE)] = WHITE
    return table


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """The batch in runs of rows with at most `limit` text bytes, or one row where that is longer."""
    _, offsets = buffers(batch.column(column))
    row = 0
    while row < len(batch):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, stop - row)
        row = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of the runs of bytes other than ASCII white space."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    white = SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, white[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, white[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(before & ~white)
    ends = np.flatnonzero(after & ~white) + 1
    return starts, ends, owners(offsets, starts)


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that holds each byte position."""
    return np.searchsorted(offsets, at, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time; spans beyond 256 bytes are finished by xxhash."""
    h = mix(lens.astype(np.uint64) + np.uint64(seed * 2 + 1))
    if not len(starts):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    h = mix(h ^ (loads[starts] & _LOW[np.minimum(lens, 8)]))
    step, idx = 8, np.flatnonzero(lens > 8)
    while idx.size and step < 256:
        h[idx] = mix(h[idx] ^ (loads[starts[idx] + step] & _LOW[np.minimum(lens[idx] - step, 8)]))
        step += 8
        idx = idx[lens[idx] > step]
    for i in idx:
        tail = xxhash.xxh3_64_intdigest(data[starts[i] + step : starts[i] + lens[i]].tobytes(), seed=seed)
        h[i] = mix(h[i : i + 1] ^ np.uint64(tail))[0]
    return h


def byte_classes(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, is lead byte) of every byte; continuation bytes carry the class of their character."""
    lead = (data & 0xC0) != 0x80
    classes = table[data]  # right for ASCII
    wide = np.flatnonzero(data >= 0xC0)
    if wide.size:
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        size = np.where(data[wide] >= 0xF0, 4, np.where(data[wide] >= 0xE0, 3, 2))
        code = padded[wide].astype(np.int64) & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
        for k in (1, 2, 3):
            more = size > k
            code[more] = (code[more] << 6) | (padded[wide[more] + k] & 0x3F)
        kinds = table[np.minimum(code, 0x10FFFF)]
        classes[wide] = kinds
        for k in (1, 2, 3):
            more = (size > k) & (wide + k < len(data))
            classes[wide[more] + k] = kinds[more]
    return classes, lead


def pretoken_starts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens of the byte-level BPE pattern start; the pre-tokens tile the texts.

    Letters, numbers and other characters form runs that take one space before them; of longer
    white space the last character stands alone, unless the text ends; 's 't 're 've 'm 'll 'd part
    from what follows when an apostrophe starts a run.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cls, lead = byte_classes(data, table)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first[n] = True
    first = first[:n]
    prev = np.empty(n, np.uint8)
    prev[0], prev[1:] = 255, cls[:-1]
    prev[first] = 255
    plain_space_before = np.zeros(n, bool)
    plain_space_before[1:] = data[:-1] == 32
    plain_space_before &= prev == WHITE
    start = (cls != prev) & ~plain_space_before
    # The last character of a run of white space before a visible character.
    last = np.zeros(n, bool)
    last[:-1] = (cls[:-1] == WHITE) & (cls[1:] != WHITE) & ~first[1:]
    at = np.flatnonzero(last)
    for _ in range(3):
        at = np.where(lead[at], at, at - 1)
    start[at] = True
    start &= lead
    start[first] = True
    # Contractions.
    quotes = np.flatnonzero(start & (data == 39))
    if quotes.size:
        end = offsets[owners(offsets, quotes) + 1]
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b = padded[quotes + 1], padded[quotes + 2]
        one = (quotes + 1 < end) & np.isin(a, np.frombuffer(b"stmd", np.uint8))
        pair = a.astype(np.int64) * 256 + b
        two = (quotes + 2 < end) & np.isin(pair, [x[0] * 256 + x[1] for x in (b"re", b"ve", b"ll")])
        for hit, size in ((one, 2), (two, 3)):
            start[quotes[hit] + 1] = False
            stop = quotes[hit] + size
            inside = stop < end[hit]
            start[stop[inside]] = True
    return np.flatnonzero(start)


def tile(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The spans between consecutive starts as a binary array over the same bytes (no copy)."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0]+lens[0]-1, starts[1] .. and so on, as one array."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)
