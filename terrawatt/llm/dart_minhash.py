"""Near-duplicate documents by DartMinHash over weighted word shingles.

A document is a weighted set: its five-word shingles with their counts. Hashed darts fall on the
plane (weight, rank) of every shingle; those below the shingle's weight hit. Each dart belongs to one
of `coordinates` cells of a signature, which keeps the earliest hit, so two signatures agree in a
cell with the probability of the weighted Jaccard similarity. Dense weights cost nothing extra: the
darts thrown depend on the signature's size, not on the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.components import components
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.textcore import SPACE, buffers, mix, slices, span_hash, word_spans
from terrawatt.llm.units import each_unit

WIDTH = 5
#: 25 bands of 6 coordinates: similarity 0.8 is found with probability 0.9995, 0.9 with 1 - 1e-8.
BANDS, ROWS = 25, 6
THRESHOLD = 0.8
#: At most so many ids are broadcast to pick the candidates' texts (a few MB); beyond, the join shuffles.
BROADCAST_IDS = 200_000
#: A bucket with more members or shingles than this is compared block by block.
BLOCK_ROWS, BLOCK_CODES = 512, 4_000_000
#: Length of the first range of ranks; every later one doubles the range.
_FIRST = 1 / 16
_NIBBLES = 0x1111111111111111
#: Marks that are not part of a word.
_MARKS = b".,;:!?\"'()"
_BREAK = SPACE.copy()
_BREAK[list(_MARKS)] = True


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(hash, document) of every word, lower case and without punctuation; number of documents."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    data, offsets = buffers(lowered)
    blank = np.where(_BREAK[data], np.uint8(32), data)
    starts, ends, doc = word_spans(blank, offsets)
    return span_hash(blank, starts, ends - starts), doc, len(offsets) - 1


def elements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(document, shingle, count), sorted by document and shingle, and the number of documents.

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    h, doc, n = _words(texts)
    if not len(h):
        return doc, h, np.zeros(0), n
    size = np.bincount(doc, minlength=n)
    first = np.cumsum(size) - size
    width = np.minimum(size, WIDTH)[doc]
    at = np.flatnonzero(np.arange(len(doc)) - first[doc] <= size[doc] - width)
    key = mix(width[at].astype(np.uint64))
    for k in range(WIDTH):
        more = width[at] > k
        key[more] = mix(key[more] ^ (h[at[more] + k] + np.uint64(k)))
    order = np.lexsort((key, doc[at]))
    d, s = doc[at][order], key[order]
    new = np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1]))
    begin = np.flatnonzero(new)
    return d[begin], s[begin], np.diff(np.append(begin, len(d))).astype(float), n


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


def _poisson(u: np.ndarray, mean: float, tables: dict[float, np.ndarray]) -> np.ndarray:
    """Numbers of darts in cells of area `mean`, from uniform numbers."""
    if mean not in tables:
        top = int(mean + 12 * math.sqrt(mean) + 20)
        tables[mean] = np.cumsum([math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(top)])
    return np.searchsorted(tables[mean], u, "right")


def dart_signature(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, coordinates: int) -> np.ndarray:
    """(n, coordinates) identities of the earliest dart of each coordinate; zeros for a document without weight.

    The plane of a shingle is cut into cells [2^v - 1, 2^(v+1) - 1) of weight by doubling ranges of
    rank. How many darts a cell has, and where, is hashed from (shingle, cell), the same in every
    document. Ranges are thrown in order; a document is done once all its coordinates are taken,
    since later ranges only hold later darts.
    """
    out = np.zeros(n * coordinates, np.uint64)
    levels = np.ceil(np.log2(weight + 1)).astype(np.int64)
    cell = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(cell)) - np.repeat(np.cumsum(levels) - levels, levels)
    open_docs = np.zeros(n, bool)
    open_docs[doc] = True
    low, width, tables, turn = 0.0, _FIRST, {}, 0
    while open_docs.any():
        live = open_docs[doc[cell]]
        cell, level = cell[live], level[live]
        base = mix(shingle[cell] ^ mix((level * 64 + turn + 1).astype(np.uint64)))
        count = np.zeros(len(cell), np.int64)
        for v in np.unique(level):
            mine = level == v
            count[mine] = _poisson(_uniform(base[mine]), float(2**v) * width, tables)
        who = np.repeat(np.arange(len(cell)), count)
        nth = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(base[who] + (nth + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        height = 2.0 ** level[who]
        hit = np.flatnonzero(height - 1 + _uniform(mix(dart ^ np.uint64(1))) * height < weight[cell[who]])
        dart, who = dart[hit], who[hit]
        slot = doc[cell[who]] * coordinates + (mix(dart ^ np.uint64(3)) % np.uint64(coordinates)).astype(np.int64)
        free = np.flatnonzero(out[slot] == 0)
        slot, dart = slot[free], dart[free]
        order = np.lexsort((dart, mix(dart ^ np.uint64(2)), slot))  # the hash is the rank within the range
        slot, dart = slot[order], dart[order]
        first = np.append(True, slot[1:] != slot[:-1])[: len(slot)]
        out[slot[first]] = dart[first] | np.uint64(1)
        open_docs &= (out.reshape(n, coordinates) == 0).any(1)
        low, width, turn = low + width, (low + width), turn + 1
    return out.reshape(n, coordinates)


def _bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One bucket key per band; the band's number is part of the key."""
    n, k = signature.shape
    keys = np.repeat(mix(np.arange(1, k // rows + 1, dtype=np.uint64))[None, :], n, 0)
    for r in range(rows):
        keys = mix(keys ^ signature[:, r::rows])
    return keys


def _sketch(signature: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen to a long."""
    n, k = signature.shape
    padded = np.zeros((n, -(-k // 16) * 16), np.uint64)
    padded[:, :k] = mix(signature) & np.uint64(15)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(padded.reshape(n, -1, 16) << shifts, axis=2)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).view(np.int64).ravel()))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, k1, k2, weight, bands, sketch) of `docs` (id, text); keys are null for a text without words.

    (k1, k2) is a 128-bit hash of the weighted set: documents that share it have similarity 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, shingle, weight, n = elements(part.column("text"))
                signature = dart_signature(doc, shingle, weight, n, bands * rows)
                some = np.bincount(doc, minlength=n) > 0
                keys = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                for k, seed in zip(keys, (11, 12), strict=True):  # sums do not depend on the order
                    np.add.at(k, doc, mix(mix(shingle ^ np.uint64(seed)) + weight.astype(np.uint64)))
                total = np.bincount(doc, weight, minlength=n).astype(float)
                none = pa.array(~some)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), *(pc.if_else(none, None, pa.array(k.view(np.int64))) for k in keys), pa.array(total),
                        _lists(_bands(signature, rows)), _lists(_sketch(signature)),
                    ],
                    names=["id", "k1", "k2", "weight", "bands", "sketch"],
                )

    return docs.mapInArrow(run, "id long, k1 long, k2 long, weight double, bands array<long>, sketch array<long>")


def coded_sets(docs: DataFrame) -> DataFrame:
    """(id, codes): each shingle of count c as c distinct codes, so that plain set sizes give weighted similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, shingle, weight, n = elements(part.column("text"))
                count = weight.astype(np.int64)
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                codes = mix(np.repeat(shingle, count) + nth.astype(np.uint64))
                size = np.bincount(doc, weight, minlength=n).astype(np.int64)
                offsets = np.append(0, np.cumsum(size)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.view(np.int64)))], names=["id", "codes"])

    return docs.mapInArrow(run, "id long, codes array<long>")


def _alike(a: Column, b: Column, threshold: float) -> Column:
    """Total weights that do not rule the threshold out."""
    return F.least(a, b) >= F.lit(threshold) * F.greatest(a, b)


class Remainder:
    """Links between the components that a bucket still holds, found inside one task.

    A unit is one bucket, or two blocks of a large one. Pairs of different components that sketches
    and weights do not rule out are verified, most alike first, and skipped once their components
    have met; what leaves the unit is at most one edge per member.
    """

    def __init__(self, threshold: float, coordinates: int):
        self.threshold = threshold
        deviation = math.sqrt(coordinates * threshold * (1 - threshold))
        self.floor = coordinates * (threshold + (1 - threshold) / 16) - 4.5 * deviation
        self.coordinates = coordinates

    def _candidates(self, key: int, side, weight, component, sketch, bands, crossed: bool):
        """(a, b, agreeing coordinates) of the pairs to verify."""
        for at in range(0, len(side), 256):
            part = slice(at, at + 256)
            differ = np.zeros((len(side[part]), len(side)), np.int64)
            for c in range(sketch.shape[1]):
                x = sketch[part, c][:, None] ^ sketch[:, c][None, :]
                x |= x >> np.uint64(2)
                x |= x >> np.uint64(1)
                differ += np.bitwise_count(x & np.uint64(_NIBBLES))
            agree = self.coordinates - differ
            fits = (agree >= self.floor) & (component[part][:, None] != component)
            fits &= np.minimum(weight[part][:, None], weight) >= self.threshold * np.maximum(weight[part][:, None], weight)
            fits &= side[part][:, None] < side if crossed else np.arange(len(side))[part][:, None] < np.arange(len(side))
            a, b = np.nonzero(fits)
            same = bands[a + at] == bands[b]
            first = bands[a + at, same.argmax(1)] == key  # a pair that shares several buckets is verified in the first
            yield a[first] + at, b[first], agree[a[first], b[first]]

    def edges(self, key: int, rep, side, weight, component, sketch, bands, codes, crossed: bool) -> list[tuple[int, int]]:
        found = list(self._candidates(key, side, weight, component, sketch, bands, crossed))
        a, b, agree = (np.concatenate(x) for x in zip(*found, strict=True))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        out, sets = [], {}
        for i in np.argsort(-agree, kind="stable").tolist():
            x, y = int(a[i]), int(b[i])
            u, v = find(int(component[x])), find(int(component[y]))
            if u == v:
                continue
            for z in (x, y):
                if z not in sets:
                    sets[z] = np.sort(codes(z))
            common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if common >= self.threshold * (len(sets[x]) + len(sets[y]) - common):
                root[max(u, v)] = min(u, v)
                out.append((int(rep[x]), int(rep[y])))
        return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, key_col: str | None = None
) -> DataFrame:
    """One row per row of `docs`: id, component_id (smallest id its links lead to), kept (the first row of its component); `key_col`, if given, is carried along.

    Words are lower case and without sentence punctuation. Documents of equal weighted shingle sets
    are one class. Classes that share a bucket are candidates; a link is a candidate pair whose exact
    weighted Jaccard similarity is at least `threshold`. First each bucket's members are compared
    with its most central member. Then, where a bucket still holds several components, its members
    are compared across components inside tasks, except where sketches (4.5 standard deviations below
    the threshold) and weights rule a pair out. So no candidate link between components is left out,
    while a bucket of true copies costs as many comparisons as it has members. Documents
    without words are never linked and kept.

    Rows go by a key of their own (`key_col`, unique longs of a stored table, or else one that is
    written with the texts first), so rows that repeat an id, or have none, are documents like others: each is
    judged by its own text, and one row of a component is kept, that of the smallest id (nulls last), then key.
    A component without ids has a null component_id. Other columns of the input are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "darts")
    coordinates = bands * rows
    key = F.col(key_col) if key_col else F.monotonically_increasing_id()
    named = docs.select(key.alias("id"), F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    named = named if key_col else scratch.keep(named, "rows")
    slim = named.select("id", "text")
    signed = scratch.keep(signatures(slim, bands, rows), "signed")
    classes = signed.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = scratch.keep(classes, "classes")

    # Buckets with several classes, and their members.
    spread = classes.select("rep", "weight", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.keep(spread.join(shared, "key"), "members")
    central = members.groupBy("rep").agg(F.sum("n").alias("central"))
    hubs = members.join(central, "rep").groupBy("key").agg(F.max(F.struct("central", (-F.col("rep")).alias("neg"), "weight")).alias("h"))
    hubs = hubs.select("key", (-F.col("h.neg")).alias("hub"), F.col("h.weight").alias("hub_weight"))
    first = members.join(hubs, "key").where("rep <> hub").where(_alike(F.col("weight"), F.col("hub_weight"), threshold))
    first = scratch.keep(first.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(), "first")

    # The candidates' shingles, once.
    ids = scratch.keep(members.select(F.col("rep").alias("id")).distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = slim.join(wanted, "id", "left_semi")
    codes = scratch.keep(coded_sets(texts), "codes")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda c: codes.select(F.col("id").alias(c), F.col("codes").alias(f"codes_{c}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a")
        common = F.size(F.array_intersect("codes_a", "codes_b"))
        similar = common >= F.lit(threshold) * (F.size("codes_a") + F.size("codes_b") - common)
        return scratch.keep(both.where(similar).select("a", "b"), name)

    links = verified(first, "links1")
    scratch.drop("first", "ids")
    merged = scratch.keep(components(links), "merged")

    # What the first comparisons left apart.
    placed = members.select("key", "rep", "weight").join(merged.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("codes")
    ).where("low <> high")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("codes") / BLOCK_CODES)).cast("int")
    left = placed.join(split.select("key", blocks.alias("blocks")), "key").withColumn("own", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
    left = left.join(classes.select("rep", "bands", "sketch"), "rep").join(codes.withColumnRenamed("id", "rep"), "rep")
    units = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "weight", "component", "bands", "sketch", "codes")
    worker = Remainder(threshold, coordinates)

    def compared(held: pa.Table) -> pa.RecordBatch:
        col = lambda c: np.asarray(held.column(c))
        table = lambda c: np.asarray(held.column(c).combine_chunks().flatten()).view(np.uint64).reshape(len(held), -1)
        key, i, j = (held.column(c)[0].as_py() for c in ("key", "i", "j"))
        sets = held.column("codes").combine_chunks()
        pairs = worker.edges(
            np.uint64(key & (2**64 - 1)), col("rep"), col("own"), col("weight"), col("component"), table("sketch"), table("bands"), lambda z: np.asarray(sets[z].values), i != j
        )
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = scratch.keep(dealt.mapInArrow(each_unit(["key", "i", "j"], compared), "a long, b long"), "links2")
    scratch.drop("members", "codes", "merged")
    merged = components(links.union(more))

    found = classes.select("k1", "k2", "rep").join(merged.withColumnRenamed("id", "rep"), "rep", "left")
    found = found.select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    placed = signed.select("id", "k1", "k2").join(found, ["k1", "k2"], "left").select("id", F.coalesce("component", "id").alias("component"))
    every = scratch.keep(named.select("id", "doc").join(placed, "id"), "placed")
    scratch.drop(*([] if key_col else ["rows"]), "signed", "classes", "links1", "links2")
    first = every.groupBy("component").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "id")).alias("first"))
    result = every.join(first, "component").select(
        F.col("doc").alias(id_col), F.col("first.doc").alias("component_id"), (F.col("id") == F.col("first.id")).alias("kept"), *([F.col("id").alias(key_col)] if key_col else [])
    )
    result = scratch.keep(result, "result")
    scratch.drop("placed")
    return result
