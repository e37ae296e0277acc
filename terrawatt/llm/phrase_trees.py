"""Phrase collocations from suffix subtrees over vertical partitions of the corpus.

A suffix is a word with up to three words that follow it in its piece of text. Words are the first
level of a suffix tree. They are packed into groups whose suffixes fit a memory budget; a word with
more suffixes than that is split by its second word, such a pair by its third, and so on. Each group
builds its subtree alone, cut at four words, and reads every phrase's count off the totals of the
leaves below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawatt.llm.ranking import ranked_by_sort
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.shipping import ship, shipped
from terrawatt.llm.textcore import buffers, mix, ragged, slices, word_spans
from terrawatt.llm.units import each_unit

DEPTH = 4
LEAST = 30
#: A phrase goes when a longer one holds it and has this share (per hundred) of its occurrences.
COVER = 80
TOP = 2000
#: Suffixes per group of prefixes: the least one, and how many prefixes can be above it at each level. Prefixes above the budget are broadcast, 24 bytes each.
BUDGET, MOST_SPLIT = 1_000_000, 1 << 20
UNIT_BYTES = 8 << 20
_ROWS = 50_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Marks that end a piece of text.
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\n\x0b\x0c\r")] = True
_HIGH = np.uint64(32)
_WORD = np.uint64(0xFFFFFFFF)
NO_LANG = "und"


class Unit:
    """The words of a run of documents as numbers; (language, word) pairs are numbered from 1, and 0 stands between pieces."""

    def __init__(self) -> None:
        self.bytes, self.known = 0, 1
        self.words: list[pa.Array] = []
        self.langs: list[pa.Array] = []
        self.streams: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch) -> None:
        data, offsets = buffers(batch.column("text"))
        data = _LOWER[data]
        marks = np.append(0, np.cumsum(_MARK[data]))
        starts, ends, doc = word_spans(np.where(_MARK[data], np.uint8(32), data), offsets)
        self.bytes += len(data)
        if not len(starts):
            return
        lens = ends - starts
        packed = data[ragged(starts, lens)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(0, np.cumsum(lens))), pa.py_buffer(packed)]).dictionary_encode()
        lang = batch.column("lang").dictionary_encode()
        wide = len(lang.dictionary)
        pair, code = np.unique(np.asarray(coded.indices).astype(np.int64) * wide + np.asarray(lang.indices)[doc], return_inverse=True)
        new = np.append(True, (doc[1:] != doc[:-1]) | (marks[starts[1:]] > marks[ends[:-1]]))
        stream = np.zeros(len(code) + new.sum(), np.int64)
        stream[np.arange(len(code)) + np.cumsum(new)] = code + self.known
        self.known += len(pair)
        self.words.append(coded.dictionary.take(pa.array(pair // wide)))
        self.langs.append(lang.dictionary.take(pa.array(pair % wide)))
        self.streams.append(stream)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """(unit, lang, word, code, n, stream): the words with their occurrences, then the stream of codes."""
        if not self.streams:
            return
        words, langs = pa.concat_arrays(self.words).dictionary_encode(), pa.concat_arrays(self.langs).dictionary_encode()
        wide = len(langs.dictionary)
        pair, code = np.unique(np.asarray(words.indices).astype(np.int64) * wide + np.asarray(langs.indices), return_inverse=True)
        stream = np.append(0, code + 1)[np.concatenate(self.streams)]
        n = np.bincount(stream, minlength=len(pair) + 1)[1:]
        word = words.dictionary.take(pa.array(pair // wide)).cast(pa.binary()).cast(pa.string())
        lang = langs.dictionary.take(pa.array(pair % wide))
        names = ["unit", "lang", "word", "code", "n", "stream"]
        for a in range(0, len(pair), _ROWS):
            b = min(a + _ROWS, len(pair))
            own = [pa.array(np.full(b - a, number)), lang[a:b], word[a:b], pa.array(np.arange(a + 1, b + 1)), pa.array(n[a:b]), pa.nulls(b - a, pa.binary())]
            yield pa.RecordBatch.from_arrays(own, names=names)
        last = [pa.array([number]), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([stream.astype("<u4").tobytes()])]
        yield pa.RecordBatch.from_arrays(last, names=names)


def _read_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, unit = TaskContext.get().partitionId() << 32, Unit()
    for batch in batches:
        for part in slices(batch, "text"):
            if unit.streams and unit.bytes + part.column("text").nbytes > UNIT_BYTES:
                yield from unit.rows(number)
                number, unit = number + 1, Unit()
            unit.add(part)
    yield from unit.rows(number)


def _numbered(budget: int):
    """Numbers the words of a partition and packs them, in their order, into groups of at most `budget` suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            f = np.minimum(np.asarray(batch.column("f")), budget)
            total = used + np.cumsum(f)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), part)), pa.array(at + np.arange(len(batch))), pa.array((part << 32) + (total - f) // budget)],
                names=[*batch.schema.names, "part", "nth", "pack"],
            )
            at, used = at + len(batch), int(total[-1]) if len(batch) else used

    return run


def _mapped(held: pa.Table) -> pa.RecordBatch:
    """One unit with the numbers of its words: its stream over frequent words, and their id, group and f / budget."""
    held = held.combine_chunks()
    blob = held.column("stream").combine_chunks()
    codes = np.frombuffer(blob.drop_null()[0].as_buffer(), "<u4")
    rows = np.flatnonzero(np.asarray(blob.is_null()))
    code, ids, packs, parts = (np.asarray(held.column(c).combine_chunks().take(pa.array(rows))).astype(np.int64) for c in ("code", "id", "pack", "parts"))
    place = np.zeros(max(int(codes.max(initial=0)), int(code.max(initial=0))) + 1, np.uint32)
    place[code] = np.arange(1, len(code) + 1)
    out = [place[codes].astype("<u4"), np.append(0, ids).astype("<u4"), np.append(-1, packs).astype("<i8"), np.append(1, parts).astype("<i8")]
    return pa.RecordBatch.from_arrays([held.column("unit")[:1].combine_chunks(), *(pa.array([x.tobytes()], pa.binary()) for x in out)], names=["unit", "stream", "ids", "packs", "parts"])


class Suffixes:
    """The suffixes of a unit as two pairs of words each; 0 where the piece has ended or a rare word stands."""

    def __init__(self, row: dict, depth: int):
        stream = np.frombuffer(row["stream"], "<u4")
        ids, self.packs, self.parts = (np.frombuffer(row[c], t) for c, t in (("ids", "<u4"), ("packs", "<i8"), ("parts", "<i8")))
        ids = ids.astype(np.uint64)
        padded = np.concatenate([stream, np.zeros(DEPTH, stream.dtype)])
        at = np.flatnonzero((stream != 0) & (padded[1 : len(stream) + 1] != 0))
        self.first = padded[at]
        self.front = _pair(ids[self.first], ids[padded[at + 1]])
        third = padded[at + 2] if depth > 2 else np.zeros(len(at), stream.dtype)
        fourth = np.where(third != 0, padded[at + 3], 0) if depth > 3 else np.zeros(len(at), stream.dtype)
        self.back = _pair(ids[third], ids[fourth])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << _HIGH | b


def _distinct(*keys: np.ndarray, n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct combinations of the keys in order, and how often (or with which sum of `n`) each occurs."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))[: len(order)]
    if n is None:
        counts = np.diff(np.append(first, len(order)))
    else:
        counts = np.add.reduceat(n[order], first) if len(first) else n[:0]
    return [k[first] for k in keys], counts


class Splits:
    """Prefixes of two and three words with more suffixes than the budget, and into how many parts each is split."""

    def __init__(self) -> None:
        none = np.zeros(0, np.uint64)
        self.two, self.two_parts = none, none
        self.three, self.three_parts = (none, none), none

    def find_two(self, key: np.ndarray) -> np.ndarray:
        """Parts of each pair of words, 0 where it is not split."""
        if not len(self.two):
            return np.zeros(len(key), np.uint64)
        at = np.minimum(np.searchsorted(self.two, key), len(self.two) - 1)
        return np.where(self.two[at] == key, self.two_parts[at], np.uint64(0))

    def find_three(self, key: np.ndarray, third: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), np.uint64)
        if len(self.three_parts):
            table = {(a, b): p for a, b, p in zip(*(x.tolist() for x in (*self.three, self.three_parts)), strict=True)}
            for i in np.flatnonzero(np.isin(key, self.three[0])).tolist():
                out[i] = table.get((int(key[i]), int(third[i])), 0)
        return out


def _groups(w: list[np.ndarray], packs: np.ndarray, parts: np.ndarray, splits: Splits) -> tuple[np.ndarray, np.ndarray]:
    """(group, least depth of the nodes that it holds whole) of each leaf."""
    group, depth = packs.astype(np.int64).copy(), np.full(len(packs), 2)
    at = np.flatnonzero(parts > 1)
    if len(at):
        own = [x[at] for x in w]
        hashed = lambda x: mix(x + np.uint64(0x51ED27))
        key = _pair(own[0], own[1])
        two = splits.find_two(key)
        three = np.zeros(len(at), np.uint64)
        deep = np.flatnonzero(two > 0)
        three[deep] = splits.find_three(key[deep], own[2][deep])
        g = mix(mix(own[0]) ^ hashed(own[1]) % parts[at].astype(np.uint64))
        g = np.where(two > 0, mix(mix(key) ^ hashed(own[2]) % np.maximum(two, np.uint64(1))), g)
        g = np.where(three > 0, mix(mix(mix(key) ^ own[2]) ^ hashed(own[3]) % np.maximum(three, np.uint64(1))), g)
        group[at] = g.view(np.int64)
        depth[at] = 2 + (two > 0) + (three > 0)
    return group, depth


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 32-bit numbers by planes of equal byte places, compressed."""
    planes = [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([p.ravel() for p in planes]).tobytes())


def _unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 4, -1)
    return [np.ascontiguousarray(p.T).view("<u4")[:, 0] for p in planes]


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield {c: batch.column(c)[i].as_buffer() for c in ("stream", "ids", "packs", "parts")}


def _subtree(least: int):
    """The nodes of one group with at least `least` occurrences, from the totals of its leaves."""

    def build(held: pa.Table) -> pa.RecordBatch:
        complete = held.column("depth")[0].as_py()
        columns = [np.concatenate(c) for c in zip(*(_unpacked(b, 5) for b in held.column("leaves").to_pylist()), strict=True)]
        w = [c.astype(np.uint64) for c in columns[:4]]
        (front, back), n = _distinct(_pair(w[0], w[1]), _pair(w[2], w[3]), n=columns[4].astype(np.int64))
        third, fourth = back >> _HIGH, back & _WORD
        change = np.append(True, front[1:] != front[:-1])
        found = []
        for depth, present in ((2, None), (3, third), (4, fourth)):
            if depth == 3:
                change = change | np.append(True, third[1:] != third[:-1])
            if depth == 4:
                change = np.ones(len(front), bool)
            first = np.flatnonzero(change)
            total = np.add.reduceat(n, first)
            fits = (total >= least) & (depth >= complete)
            if present is not None:
                fits &= present[first] != 0
            first, total = first[fits], total[fits]
            zero = np.zeros(len(first), np.uint64)
            found.append([front[first] >> _HIGH, front[first] & _WORD, third[first] if depth > 2 else zero, fourth[first] if depth > 3 else zero, total])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)], names=["w1", "w2", "w3", "w4", "a"])

    return build


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int, depth: int, budget: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), (id, lang, word, f) and (w1 .. w4, a): words by language, frequent words, and phrases of 2 to `depth` words, with `a` >= `least`.

    Word counts come first, folded by units of about 8 MB of text; a word below `least` ends every
    phrase. Suffixes are folded to distinct leaves in their unit and sent to their group packed, one
    row per unit and group. Prefixes above the budget are at most words / budget, so their
    tables are bounded when `budget` is at least words / 2^20, which is enforced.
    """
    spark = docs.sparkSession
    counted = scratch.keep(docs.mapInArrow(_read_units, "unit long, lang string, word string, code long, n long, stream binary"), "counted")
    vocab = counted.where("word IS NOT NULL")
    langs = scratch.keep(vocab.groupBy("lang").agg(F.sum("n").alias("n")), "langs")
    words = int(langs.agg(F.sum("n")).first()[0] or 0)
    budget = max(budget, words // MOST_SPLIT)
    frequent = vocab.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    frequent = scratch.keep(frequent.mapInArrow(_numbered(budget), "lang string, word string, f long, part long, nth long, pack long"), "numbered")
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per partition
    starts = frequent.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", before.alias("before"))
    frequent = scratch.keep(frequent.join(starts, "part").select((F.col("before") + F.col("nth") + 1).alias("id"), "lang", "word", "f", "pack"), "frequent")
    if (frequent.agg(F.max("id")).first()[0] or 0) >= 1 << 32:
        raise ValueError("more than 4,294,967,295 frequent words")
    parts = F.ceil(F.col("f") / F.lit(budget))
    known = vocab.join(frequent, ["lang", "word"]).select("unit", "code", "id", "pack", parts.alias("parts"), F.lit(None).cast("binary").alias("stream"))
    none = [F.lit(None).cast("long").alias(c) for c in ("code", "id", "pack", "parts")]
    rows = known.unionByName(counted.where("word IS NULL").select("unit", *none, "stream"))
    units = rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(each_unit(["unit"], _mapped), "unit long, stream binary, ids binary, packs binary, parts binary")
    units = scratch.keep(units, "units")

    splits, whole = Splits(), []
    if not frequent.where(F.col("f") > budget).isEmpty():
        for level in (2, 3)[: depth - 1]:
            parcel = ship(spark, splits)

            def extended(batches: Iterator[pa.RecordBatch], level=level, parcel=parcel) -> Iterator[pa.RecordBatch]:
                have = shipped(parcel)
                for row in _unit_rows(batches):
                    own = Suffixes(row, depth)
                    split = own.parts[own.first] > 1
                    key, third = own.front[split], np.zeros(split.sum(), np.uint64)
                    if level == 3:
                        deep = have.find_two(key) > 0
                        key, third = key[deep], own.back[split][deep] >> _HIGH
                        key, third = key[third != 0], third[third != 0]
                    (key, third), n = _distinct(key, third)
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (key >> _HIGH, key & _WORD, third, np.zeros(len(n)), n)], names=["w1", "w2", "w3", "w4", "a"])

            sums = units.mapInArrow(extended, "w1 long, w2 long, w3 long, w4 long, a long").groupBy("w1", "w2", "w3", "w4").agg(F.sum("a").alias("a"))
            above = scratch.keep(sums.where(F.col("a") > budget), f"above{level}")
            whole.append(above)
            got = above.orderBy("w1", "w2", "w3").toPandas()  # at most words / budget rows
            key, many = _pair(got.w1.to_numpy(np.uint64), got.w2.to_numpy(np.uint64)), -(-got.a.to_numpy(np.int64) // budget)
            if level == 2:
                splits.two, splits.two_parts = key, many.astype(np.uint64)
            else:
                splits.three, splits.three_parts = (key, got.w3.to_numpy(np.uint64)), many.astype(np.uint64)
            if not len(got):
                break
    parcel = ship(spark, splits)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shipped(parcel)
        for row in _unit_rows(batches):
            own = Suffixes(row, depth)
            (first, front, back), n = _distinct(own.first, own.front, own.back)
            w = [front >> _HIGH, front & _WORD, back >> _HIGH, back & _WORD]
            group, whole_from = _groups(w, own.packs[first], own.parts[first], have)
            order = np.lexsort((whole_from, group))
            group, whole_from, n = group[order], whole_from[order], n[order]
            w = [x[order] for x in w]
            cuts = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (whole_from[1:] != whole_from[:-1])))[: len(group)]
            for a, b in zip(cuts.tolist(), np.append(cuts, len(group))[1:].tolist(), strict=True):
                blob = _packed([*(x[a:b] for x in w), n[a:b]])
                yield pa.RecordBatch.from_arrays([pa.array([int(group[a])]), pa.array([int(whole_from[a])]), pa.array([blob])], names=["grp", "depth", "leaves"])

    dealt = units.mapInArrow(leaves, "grp long, depth long, leaves binary").repartition("grp", "depth").sortWithinPartitions("grp", "depth")
    nodes = dealt.mapInArrow(each_unit(["grp", "depth"], _subtree(least)), "w1 long, w2 long, w3 long, w4 long, a long")
    for above in whole:  # split prefixes: their totals are those that made them split
        nodes = nodes.unionByName(above.where(F.col("a") >= least))
    nodes = scratch.keep(nodes, "nodes")
    scratch.drop("counted", "numbered", "units", "above2", "above3")
    return langs, frequent.drop("pack"), nodes


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, depth: int = DEPTH, cover: int = COVER, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to `depth` (at most 4) words.

    Text is lower-cased in A-Z and cut into pieces at . , ; : ! ? and line ends, pieces into words at
    spaces and tabs; phrases stay within a piece and all their occurrences count, overlapping ones too.
    A phrase of `a` >= `least` occurrences is cut in two where its score, floor(2000000 a / (l + r)) over
    the occurrences of both parts, is lowest (then first). It goes when a longer candidate holds it with
    100 x occurrences >= `cover` x a. The best `top` by (score, a) descending, then phrase, are ranked from 1;
    n is all words of the language. Null text is empty, null language `und`. Repeated rows count
    again. Languages without candidates and empty tables give no rows; other columns are ignored.
    """
    if not 2 <= depth <= DEPTH:
        raise ValueError(f"depth must be 2 to {DEPTH}")
    scratch = Scratch(docs.sparkSession, "phrases")
    slim = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"))
    langs, frequent, nodes = phrase_counts(slim, scratch, least, depth, budget)
    zero, w = F.lit(0).cast("long"), [F.col(f"w{k}") for k in range(1, 5)]
    size = F.when(w[3] > 0, 4).when(w[2] > 0, 3).otherwise(2)

    def part(words: list[Column]) -> list[Column]:
        return [(words + [zero] * 3)[k].alias(f"p{k + 1}") for k in range(3)]

    # Both parts of every cut meet their counts in one join.
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), *part(w[:k] if left else w[k:])) for k in (1, 2, 3) for left in (True, False)])
    wanted = nodes.withColumn("size", size).withColumn("cut", F.explode(cuts)).where("cut.k < size").select(*w, "a", "cut.*")
    have = nodes.where("w4 = 0").select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("w3").alias("p3"), F.col("a").alias("f"))
    have = have.unionByName(frequent.select(F.col("id").alias("p1"), zero.alias("p2"), zero.alias("p3"), "f"))
    met = wanted.join(have, ["p1", "p2", "p3"]).groupBy("w1", "w2", "w3", "w4", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _wide(F.col("a")), _wide(F.col("l") + F.col("r")))
    scored = met.withColumn("score", score).groupBy("w1", "w2", "w3", "w4", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    pieces = [(2, i, i + 2) for i in range(3)] + [(3, i, i + 3) for i in range(2)]
    inner = F.array(*[F.struct(F.lit(stop).alias("stop"), F.lit(n).alias("n"), *part(w[start:stop])) for n, start, stop in pieces])
    inside = nodes.withColumn("size", size).where("size > 2").withColumn("of", F.explode(inner)).where("of.stop <= size AND of.n < size")
    longer = inside.groupBy(F.col("of.p1").alias("w1"), F.col("of.p2").alias("w2"), F.col("of.p3").alias("w3")).agg(F.max("a").alias("longest")).withColumn("w4", zero)
    held = _wide(F.col("longest")) * 100 >= _wide(F.col("a")) * cover
    kept = scored.join(longer, ["w1", "w2", "w3", "w4"], "left").where(F.coalesce(~held, F.lit(True))).select("w1", "w2", "w3", "w4", "a", "best.score", "best.l", "best.r")
    kept = scratch.keep(kept.join(frequent.select(F.col("id").alias("w1"), "lang"), "w1"), "kept")

    # Scores are at most a million: a histogram tells the one below which nothing can be among the best.
    above = F.coalesce(F.sum("many").over(Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    floor = kept.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("many")).withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("score").alias("floor"))
    best = kept.join(floor, "lang").where("score >= floor").drop("floor")
    spots = best.select(*w, F.posexplode(F.array(*w)).alias("pos", "id")).where("id > 0").join(frequent.select("id", "word"), "id")
    names = spots.groupBy("w1", "w2", "w3", "w4").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
    named = best.join(names, ["w1", "w2", "w3", "w4"]).select("lang", F.concat_ws(" ", "words.word").alias("phrase"), "a", "l", "r", "score", (-F.col("score")).alias("by_score"), (-F.col("a")).alias("by_a"))
    placed = ranked_by_sort(named, "lang", ["by_score", "by_a", "phrase"], "rank").where(F.col("rank") < top)
    result = placed.join(langs, "lang").select("lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
    result = scratch.keep(result, "result")
    scratch.drop("langs", "frequent", "nodes", "kept")
    return result
