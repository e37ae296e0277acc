"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a
pre-token is the sum over all its segmentations into pieces, which a forward pass over its bytes
computes; a text's score is the sum of the logarithms over its pre-tokens with letters. Piece
probabilities are learned by expectation maximisation over the same segmentations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.llm.scratch import Scratch
from terrawatt.llm.shipping import ship, shipped
from terrawatt.llm.textcore import LETTER, buffers, byte_classes, class_table, mix, pretoken_starts, slices, tile
from terrawatt.llm.vocab_hash import VocabHash, Vocabulary, read_ranks

#: Pieces of at most this many bytes fit 64 bits with their length; longer ones are compared byte by byte.
PIECE_BYTES = 7
#: Forward and backward sums are rescaled after so many bytes, which keeps them within the range of doubles.
STEP_BYTES = 16
#: Bytes of pre-tokens that are worked on at once.
GRID_BYTES = 1 << 16
#: Longer pre-tokens are walked byte by byte, so many positions at a time.
LONG_BYTES, WALK_BYTES = 256, 1 << 14
#: Training documents per language, in expectation (documented bound of the fit).
TRAIN_DOCS = 400
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(PIECE_BYTES + 1)], np.uint64)


class Pieces:
    """The vocabulary's pieces: short ones by an exact 64-bit key, longer ones (ids from `short` on) by a hash and their bytes."""

    def __init__(self, ranks_path: str):
        tokens = set(read_ranks(ranks_path)) - {b""}
        pieces = sorted({t for t in tokens if len(t) <= PIECE_BYTES} | {bytes([b]) for b in range(256)})
        keys = np.array([int.from_bytes(t, "little") | len(t) << 56 for t in pieces], np.uint64)
        self.hash = VocabHash(mix(keys))
        self.short = len(pieces)
        longer = sorted(t for t in tokens if len(t) > PIECE_BYTES)
        self.longer = Vocabulary(longer)
        self.sizes = sorted({len(t) for t in longer})
        #: The first 8 bytes of longer pieces; few places of a text pass.
        self.heads = VocabHash(mix(np.unique(np.array([int.from_bytes(t[:8], "little") for t in longer], np.uint64))))
        self.n = len(pieces) + len(longer)
        self.lens = np.array([len(t) for t in pieces + longer])

    def starting(self, loads: np.ndarray, length: int) -> np.ndarray:
        """The piece of `length` bytes, PIECE_BYTES at most, in each 8-byte load, or `n` where there is none."""
        found = self.hash.find(mix((loads & _LOW[length]) | np.uint64(length << 56)))
        return np.where(found < 0, self.n, found)


def _grid(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(word index, bytes as a matrix with 8 more columns, length) for whole words of equal length."""
    data, offsets = buffers(words)
    lens = np.diff(offsets)
    order = np.argsort(lens, kind="stable")
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for length in np.unique(lens[lens > 0]).tolist():
        group = order[np.searchsorted(lens[order], length) : np.searchsorted(lens[order], length, "right")]
        many = max(1, GRID_BYTES // length)
        for at in range(0, len(group), many):
            part = group[at : at + many]
            yield part, padded[offsets[:-1][part][:, None] + np.arange(length + 8)], length


def _found(pieces: Pieces, cells: np.ndarray, length: int) -> list[list[tuple[int, np.ndarray]]]:
    """found[i]: (bytes, the piece of so many bytes that starts at byte i of each word), for each size met there."""
    out = [[] for _ in range(length)]
    loads = [np.ascontiguousarray(cells[:, i : i + 8]).view("<u8")[:, 0] for i in range(length)]
    for i in range(length):
        out[i] = [(size, pieces.starting(loads[i], size)) for size in range(1, min(PIECE_BYTES, length - i) + 1)]
    for i in range(length - PIECE_BYTES):
        rows = np.flatnonzero(pieces.heads.find(mix(loads[i])) >= 0)
        for size in pieces.sizes if len(rows) else []:
            if size > length - i:
                break
            spans = np.ascontiguousarray(cells[rows, i : i + size]).ravel()
            offsets = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int64) * size)
            ids = pieces.longer.ids(pa.Array.from_buffers(pa.large_binary(), len(rows), [None, offsets, pa.py_buffer(spans)]))
            if (ids >= 0).any():
                whole = np.full(len(cells), pieces.n)
                whole[rows[ids >= 0]] = ids[ids >= 0] + pieces.short
                out[i].append((size, whole))
    return out


def _sums(moves: list[list[tuple[int, np.ndarray]]], length: int, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(sums over all segmentations up to each byte, logarithm of their scale); moves[i] are (bytes, probability) from byte i."""
    alpha, scale = np.zeros((length + 1, *shape)), np.zeros((length + 1, *shape))
    alpha[0] = 1.0
    longest = max(size for row in moves for size, _ in row)
    for i in range(length):
        if i:
            scale[i] = scale[i - 1]
        if i and i % STEP_BYTES == 0:
            by = alpha[i].copy()
            alpha[i : i + longest + 1] /= by
            scale[i] += np.log(by)
        for size, q in moves[i]:
            alpha[i + size] += alpha[i] * q
    scale[length] = scale[length - 1]
    return alpha, scale


class Walk:
    """One long pre-token, a stretch of positions at a time."""

    def __init__(self, word: bytes, pieces: Pieces):
        self.word, self.pieces, self.n = word, pieces, len(word)
        self.longest = max([PIECE_BYTES, *pieces.sizes])

    def stretches(self) -> Iterator[tuple[int, np.ndarray, dict[int, list[tuple[int, int]]]]]:
        """(first position, ids of the pieces of 1 .. PIECE_BYTES bytes from each position, longer ones as position -> (bytes, id))."""
        for at in range(0, self.n, WALK_BYTES):
            n = min(WALK_BYTES, self.n - at)
            data = np.frombuffer(self.word, np.uint8, min(n + self.longest, self.n - at), at)
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            loads = np.ndarray((n,), "<u8", buffer=padded, strides=(1,)).copy()
            ids = np.full((n, PIECE_BYTES), self.pieces.n)
            for size in range(1, PIECE_BYTES + 1):
                fits = max(0, min(n, self.n - at - size + 1))
                ids[:fits, size - 1] = self.pieces.starting(loads[:fits], size)
            longer: dict[int, list[tuple[int, int]]] = {}
            rows = np.flatnonzero(self.pieces.heads.find(mix(loads)) >= 0)
            for size in self.pieces.sizes:
                rows = rows[rows + size <= len(data)]
                if not len(rows):
                    break
                spans = np.ascontiguousarray(padded[rows[:, None] + np.arange(size)]).ravel()
                offsets = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int64) * size)
                found = self.pieces.longer.ids(pa.Array.from_buffers(pa.large_binary(), len(rows), [None, offsets, pa.py_buffer(spans)]))
                for row, piece in zip(rows[found >= 0].tolist(), found[found >= 0].tolist(), strict=True):
                    longer.setdefault(row, []).append((size, piece + self.pieces.short))
            yield at, ids, longer

    def forward(self, probs: np.ndarray) -> np.ndarray:
        """log P by column of `probs`; only the sums of one stretch are held."""
        wide = probs.shape[1]
        alpha, scale = np.vstack([np.ones((1, wide)), np.zeros((self.longest - 1, wide))]), np.zeros(wide)
        for at, ids, longer in self.stretches():
            n = len(ids)
            sums = np.vstack([alpha, np.zeros((n, wide))])
            moves = probs[ids]
            for i in range(n):
                if (at + i) % STEP_BYTES == 0:
                    by = sums[i : i + self.longest].max(0)
                    sums[i : i + self.longest] /= by
                    scale += np.log(by)
                sums[i + 1 : i + PIECE_BYTES + 1] += moves[i] * sums[i]
                for size, piece in longer.get(i, ()):
                    sums[i + size] += sums[i] * probs[piece]
            alpha = sums[n:]
        return np.log(alpha[0]) + scale

    def _logs(self, state: tuple[np.ndarray, float], at: int, moves: np.ndarray, longer: dict[int, list[tuple[int, float]]]) -> tuple[np.ndarray, tuple[np.ndarray, float]]:
        """(logarithms of the sums at a stretch of positions, state for the next one); moves[i] and longer[i] lead on from the i-th."""
        n = len(moves)
        sums, scale = np.append(state[0], np.zeros(n)), state[1]
        logs = np.zeros(n)
        for i in range(n):
            if (at + i) % STEP_BYTES == 0:
                by = sums[i : i + self.longest].max()
                sums[i : i + self.longest] /= by
                scale += float(np.log(by))
            logs[i] = scale
            sums[i + 1 : i + PIECE_BYTES + 1] += moves[i] * sums[i]
            for size, q in longer.get(i, ()):
                sums[i + size] += sums[i] * q
        with np.errstate(divide="ignore"):  # a sum too small beside its neighbours counts as none
            return logs + np.log(sums[:n]), (sums[n:], scale)

    def count(self, probs: np.ndarray, times: float, total: np.ndarray) -> None:
        """Adds `times` the expected uses of each piece under one language's probabilities.

        The logarithms of the sums are kept, one number per byte forward and one backward, and the pieces met.
        """
        up, down = np.zeros(self.n + 1), np.zeros(self.n + 1)  # up to each byte, and from it on
        start = np.append(1.0, np.zeros(self.longest - 1)), 0.0
        state, ids, ends = start, [], {}
        for at, own, longer in self.stretches():
            up[at : at + len(own)], state = self._logs(state, at, probs[own], {i: [(size, probs[piece]) for size, piece in met] for i, met in longer.items()})
            ids.append(own.astype(np.int32))
            for i, met in longer.items():
                for size, piece in met:
                    ends.setdefault(at + i + size, []).append((size, piece))
        up[self.n] = state[1] + np.log(state[0][0])
        ids, size, state = np.concatenate(ids), np.arange(1, PIECE_BYTES + 1), start
        for at in range(0, self.n, WALK_BYTES):  # from the end, over the pieces that end at each byte
            end = self.n - np.arange(at, min(at + WALK_BYTES, self.n))
            first = end[:, None] - size
            moves = np.where(first >= 0, probs[ids[np.maximum(first, 0), size - 1]], 0.0)
            longer = {i: [(n, probs[piece]) for n, piece in ends[e]] for i, e in enumerate(end.tolist()) if e in ends}
            down[end], state = self._logs(state, at, moves, longer)
        for at in range(0, self.n, WALK_BYTES):
            own = ids[at : at + WALK_BYTES]
            reach = np.minimum(np.arange(at, at + len(own))[:, None] + size, self.n)
            uses = probs[own] * np.exp(up[at : at + len(own), None] + down[reach] - up[self.n])
            np.add.at(total, own.ravel(), uses.ravel() * times)
        for end, met in ends.items():
            for n, piece in met:
                total[piece] += times * probs[piece] * np.exp(up[end - n] + down[end] - up[self.n])


def _parted(words: pa.Array) -> tuple[np.ndarray, list[int]]:
    """(numbers of the words of up to LONG_BYTES bytes, those of longer ones)."""
    long = np.asarray(pc.binary_length(words)) > LONG_BYTES
    return np.flatnonzero(~long), np.flatnonzero(long).tolist()


def forward(words: pa.Array, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """log P(word | language), one row per word; `probs` has pieces + 1 rows, the last one zero."""
    logs = np.zeros((len(words), probs.shape[1]))
    short, long = _parted(words)
    for i in long:
        logs[i] = Walk(words[i].as_py(), pieces).forward(probs)
    for own, cells, length in _grid(words.take(pa.array(short))):
        index = short[own]
        moves = [[(size, probs[ids]) for size, ids in row] for row in _found(pieces, cells, length)]
        alpha, scale = _sums(moves, length, (len(index), probs.shape[1]))
        logs[index] = np.log(alpha[length]) + scale[length]
    return logs


def expected_counts(words: pa.Array, langs: np.ndarray, counts: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language: forward and backward sums over all segmentations."""
    total = np.zeros((pieces.n + 1, probs.shape[1]))
    short, long = _parted(words)
    for i in long:
        own = np.zeros(pieces.n + 1)
        Walk(words[i].as_py(), pieces).count(probs[:, langs[i]], counts[i], own)
        total[:, langs[i]] += own
    for own, cells, length in _grid(words.take(pa.array(short))):
        index = short[own]
        found = _found(pieces, cells, length)
        lang = langs[index]
        moves = [[(size, probs[ids, lang]) for size, ids in row] for row in found]
        back: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(length)]
        for i, row in enumerate(moves):
            for size, q in row:
                back[length - i - size].append((size, q))
        alpha, up = _sums(moves, length, (len(index),))
        beta, down = _sums(back, length, (len(index),))
        beta, down = beta[::-1], down[::-1]
        whole = np.log(alpha[length]) + up[length]
        for i in range(length):
            for (size, q), (_, ids) in zip(moves[i], found[i], strict=True):
                share = np.exp(up[i] + down[i + size] - whole)
                np.add.at(total, (ids, lang), alpha[i] * q * beta[i + size] * share * counts[index])
    return total[:-1]


def normalised(counts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Piece probabilities by language, with a small share for unseen pieces; a zero row at the end."""
    smooth = np.where(lens == 1, 1e-3, 1e-5)[:, None]
    p = counts + smooth * np.maximum(1.0, counts.sum(0) * 1e-4)
    return np.vstack([p / p.sum(0), np.zeros(counts.shape[1])])


class Words:
    """Pre-tokens with letters of a batch, lower case: distinct ones, and which document uses which."""

    def __init__(self, texts: pa.Array, classes: np.ndarray):
        data, offsets = buffers(texts)
        starts = pretoken_starts(data, offsets, classes)
        kind, _ = byte_classes(data, classes) if len(data) else (np.zeros(0, np.uint8), None)
        ends = np.append(starts[1:], len(data))
        letters = np.append(0, np.cumsum(kind == LETTER))
        keep = letters[ends] > letters[starts] if len(starts) else np.zeros(0, bool)
        coded = tile(data, starts).dictionary_encode()
        lowered = pc.utf8_lower(coded.dictionary.cast(pa.large_string())).dictionary_encode()
        self.distinct = lowered.dictionary.cast(pa.large_binary())
        self.codes = np.asarray(lowered.indices)[np.asarray(coded.indices)[keep]] if len(starts) else np.zeros(0, np.int64)
        self.doc = np.searchsorted(offsets, starts[keep], "right") - 1 if len(starts) else np.zeros(0, np.int64)


def train(docs: DataFrame, ranks_path: str, rounds: int = 2, train_docs: int = TRAIN_DOCS):
    """(languages, shares, probabilities) from the rows of `docs` (id, text, lang).

    Rows are taken by a hash of their id so that each language has about `train_docs`; a language
    with fewer keeps them all. Their word counts by language are one Spark aggregation, each round
    of expectation maximisation another; only the model, pieces x languages, comes to the driver.
    """
    spark = docs.sparkSession
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    pieces = Pieces(ranks_path)
    if not langs:
        return [], np.zeros(0), np.zeros((pieces.n + 1, 0)), pieces
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, train_docs / sizes[k]))])
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    shared = ship(spark, (pieces, class_table()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shipped(shared)[1]
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), classes)
                lang = np.array([langs.index(x) for x in part.column("lang").to_pylist()])
                key, n = np.unique(lang[words.doc] * max(1, len(words.distinct)) + words.codes, return_counts=True)
                which = key // max(1, len(words.distinct))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which.astype(np.int32)), words.distinct.cast(pa.binary()).take(pa.array(key - which * max(1, len(words.distinct)))), pa.array(n)],
                    names=["lang", "word", "n"],
                )

    scratch = Scratch(spark, "langid")
    counted = chosen.select("text", "lang").mapInArrow(count, "lang int, word binary, n long")
    counted = scratch.keep(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")

    def expect(probs: np.ndarray) -> np.ndarray:
        model = spark.sparkContext.broadcast(probs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = shipped(shared)[0], None
            for batch in batches:
                got = expected_counts(batch.column("word"), np.asarray(batch.column("lang")), np.asarray(batch.column("n"), float), own, model.value)
                total = got if total is None else total + got
            if total is not None:
                piece, lang = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        summed = counted.mapInArrow(run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros((pieces.n, len(langs)))
        out[summed.piece.to_numpy(int), summed.lang.to_numpy(int)] = summed.n
        return out

    # Start from pieces whose probability falls with their length, the same for every language.
    probs = normalised(np.repeat((4.0 ** -pieces.lens)[:, None], len(langs), 1) * 1e6, pieces.lens)
    for _ in range(rounds):
        probs = normalised(expect(probs), pieces.lens)
    scratch.drop("words")
    weight = np.array([sizes[k] for k in langs], float)
    return langs, weight / weight.sum(), probs, pieces


def identify(docs: DataFrame, training: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with `lang_pred` and `score`: the language of highest posterior and that posterior.

    `training` has (id, text, lang). `lang_pred` is `und` with score 0 where the text is null, has no
    letter, or nothing could be learned. Ties go to the alphabetically first language. Repeated rows
    each get a row; other columns are passed on, but for any called `lang_pred` or `score`.
    """
    spark = docs.sparkSession
    langs, shares, probs, pieces = train(training, ranks_path)
    shared = ship(spark, (pieces, class_table(), probs, np.log(shares)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, classes, model, prior = shipped(shared)
        for batch in batches:
            for part in slices(batch, text_col):
                words = Words(part.column(text_col), classes)
                n = len(part)
                counts = np.bincount(words.doc, minlength=n)
                best, score = np.zeros(n, int), np.zeros(n)
                if langs:
                    logs = forward(words.distinct, own, model)[words.codes]
                    total = np.stack([np.bincount(words.doc, logs[:, k], minlength=n) for k in range(len(langs))], 1) + prior
                    total -= total.max(1, keepdims=True)
                    best = total.argmax(1)
                    score = 1 / np.exp(total).sum(1)
                named = [langs[b] if c and langs else "und" for b, c in zip(best, counts, strict=True)]
                score = np.where((counts > 0) & bool(langs), score, 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(named, pa.string()), pa.array(score)], names=[*part.schema.names, "lang_pred", "score"])

    rows = docs.drop("lang_pred", "score")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
