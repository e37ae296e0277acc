"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Normalised vectors are projected on random directions; each projection is shifted and cut into
steps of width `width`, and `projections` step numbers together are a vector's bucket in one of
`tables` tables. For unit vectors a cosine is a Euclidean distance, so similar vectors share steps.
Vectors that share a bucket are compared exactly, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.components import components
from terrawatt.llm.scratch import Scratch
from terrawatt.llm.textcore import mix
from terrawatt.llm.units import each_unit

THRESHOLD = 0.9
#: A pair at cosine 0.9 meets in some table with probability 0.997, at 0.95 with 1 - 6e-6.
TABLES, PROJECTIONS, STEP = 40, 10, 2.0
#: Vectors that are compared with each other at once; larger buckets become pairs of such blocks.
BLOCK = 1024
_UNIT, _DIRECTION = 2.0**20, 2.0**10


def unit_rows(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows in double precision, their norms)."""
    v = np.ascontiguousarray(v, dtype=float)
    return v, np.sqrt((v * v).sum(axis=1))


class Hashing:
    """Bucket keys of vectors of any length; the random directions are drawn once per length."""

    def __init__(self, tables: int = TABLES, projections: int = PROJECTIONS, step: float = STEP):
        self.tables, self.projections, self.step = tables, projections, step
        self.drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def directions(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        if dim not in self.drawn:
            rng, n = np.random.default_rng(20_000 + dim), self.tables * self.projections
            self.drawn[dim] = np.rint(rng.standard_normal((dim, n)) * _DIRECTION), np.rint(rng.random(n) * self.step * _UNIT * _DIRECTION)
        return self.drawn[dim]

    def table_seeds(self, dim: int) -> np.ndarray:
        return mix(np.arange(1, self.tables + 1, dtype=np.uint64) + np.uint64(dim << 20))

    def keys(self, v: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """(rows, tables) bucket keys. Integers stand for the operands, so sums are exact in any order
        and a vector has the same keys in whatever batch it comes."""
        dim = v.shape[1]
        directions, shift = self.directions(dim)
        dots = np.rint(v / norms[:, None] * _UNIT) @ directions
        cells = np.floor((dots + shift) / (self.step * _UNIT * _DIRECTION)).astype(np.int64).view(np.uint64)
        cells = cells.reshape(len(v), self.tables, self.projections)
        keys = np.repeat(self.table_seeds(dim)[None, :], len(v), 0)
        for p in range(self.projections):
            keys = mix(keys ^ cells[:, :, p])
        return keys


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for the usable vectors of each length: no null, non-finite or all-zero ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
    size = np.asarray(pc.list_value_length(column).fill_null(0)).astype(np.int64)
    first = np.cumsum(size) - size
    for dim in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == dim)
        v = flat[first[rows][:, None] + np.arange(dim)]
        good = np.isfinite(v).all(1) & (v != 0).any(1)
        v, norms = unit_rows(v[good])
        fine = np.isfinite(norms) & (norms > 0)
        yield rows[good][fine], v[fine]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, d1, d2): a 128-bit hash of each usable vector's components, else nulls."""
    for batch in batches:
        n = len(batch)
        d = np.zeros((2, n), np.uint64)
        known = np.zeros(n, bool)
        for rows, v in _matrices(batch.column("v")):
            bits = (v + 0.0).view(np.uint64)
            for k in range(2):
                h = mix(np.full(len(v), v.shape[1] * 2 + k + 1, np.uint64))
                for c in range(v.shape[1]):
                    h = mix(h ^ bits[:, c])
                d[k, rows] = h
            known[rows] = True
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x.view(np.int64), mask=~known) for x in d)], names=["id", "d1", "d2"])


class Block:
    """Compares the vectors of one unit: all of one bucket, or two blocks of a large one."""

    def __init__(self, threshold: float, hashing: Hashing):
        self.threshold, self.hashing = threshold, hashing

    def compare(self, key: int, rep: np.ndarray, copies: np.ndarray, v: np.ndarray, side: np.ndarray, second: bool):
        """(rep, links that this table finds first, smallest rep linked here), for reps with a link."""
        order = np.argsort(rep, kind="stable")
        rep, copies, side = rep[order], copies[order], side[order]
        v, norms = unit_rows(v[order])
        near = (v @ v.T) / norms / norms[:, None] >= self.threshold
        np.fill_diagonal(near, False)
        if second:
            near &= side[:, None] != side
        a, b = np.nonzero(near)
        if not len(a):
            return rep[:0], copies[:0], rep[:0]
        n = len(rep)
        keys = self.hashing.keys(v, norms)
        table = int(np.flatnonzero(keys[0].view(np.int64) == key)[0])
        links = np.zeros(n, np.int64)
        for at in range(0, len(a), 1 << 17):
            x, y = a[at : at + (1 << 17)], b[at : at + (1 << 17)]
            mine = (keys[x] == keys[y]).argmax(1) == table
            links += np.bincount(x[mine], copies[y[mine]], minlength=n).astype(np.int64)
        label = np.arange(n)
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            new = new[new]
            if (new == label).all():
                break
            label = new
        used = np.zeros(n, bool)
        used[a] = True
        return rep[used], links[used], rep[label[used]]


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
    tables: int = TABLES, projections: int = PROJECTIONS, step: float = STEP, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links (other vectors directly linked), component_id (smallest id that
    links lead to), kept (id = component_id).

    Equal vectors form a class that is hashed once; its members link with each other. A link needs a
    cosine of at least `threshold` in double precision, and vectors of equal length. A link found in
    several tables counts in the first. A bucket above `block` vectors is cut into blocks by a hash of
    the id, and each pair of blocks is compared on its own; what leaves a comparison are counts and one
    edge per vector, never pairs. Vectors that are null, zero or hold null or non-finite components
    link with nothing. Each row is a vector of its own under a key that is written first, so rows that
    repeat an id, or have none, link like others; component_id is then the smallest id of the component's rows,
    null if they have none, and a row without id is kept where it is the first row of such a component.
    Other columns of the input are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "pstable")
    named = scratch.keep(vectors.select(F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("long").alias("vec"), F.col(vector_col).alias("v")), "rows")
    slim = named.select("id", F.col("v").cast("array<double>").alias("v"))
    prints = scratch.keep(slim.mapInArrow(_fingerprints, "id long, d1 long, d2 long"), "prints")
    classes = prints.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.keep(classes, "classes")

    hashing = Hashing(tables, projections, step)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((len(batch), tables), np.uint64)
            for rows, v in _matrices(batch.column("v")):
                keys[rows] = hashing.keys(*unit_rows(v))
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * tables
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "keys"])

    chosen = slim.join(classes.select(F.col("rep").alias("id"), "copies"), "id")
    reps = chosen.select(F.col("id").alias("rep"), "copies", "v").mapInArrow(hashed, "rep long, copies long, v array<double>, keys array<long>")
    reps = scratch.keep(reps.select("rep", "copies", F.col("v").cast("array<float>" if _single(vectors, vector_col) else "array<double>").alias("v"), "keys"), "reps")
    sizes = reps.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = scratch.keep(sizes, "sizes")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int")
    spread = reps.select("rep", "copies", "v", F.explode("keys").alias("key")).join(sizes.select("key", blocks.alias("blocks")), "key").withColumn("own", own)
    units = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "copies", "v")
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    worker = Block(threshold, hashing)

    def compared(held: pa.Table) -> pa.RecordBatch:
        col = lambda c: np.asarray(held.column(c))
        matrix = np.asarray(held.column("v").combine_chunks().flatten()).reshape(len(held), -1)
        key, i, j = (held.column(c)[0].as_py() for c in ("key", "i", "j"))
        got = worker.compare(key, col("rep"), col("copies"), matrix, col("own"), i != j)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["rep", "links", "low"])

    found = scratch.keep(dealt.mapInArrow(each_unit(["key", "i", "j"], compared), "rep long, links long, low long"), "found")
    scratch.drop("reps", "sizes")
    merged = components(found.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct())
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    summary = classes.join(counted, "rep", "left").join(merged.withColumnRenamed("id", "rep"), "rep", "left").select(
        "d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    placed = prints.join(summary, ["d1", "d2"], "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))
    placed = scratch.keep(named.select("id", "vec").join(placed, "id"), "placed")
    first = placed.groupBy("component").agg(F.min("vec").alias("component_id"), F.min("id").alias("first"))
    result = placed.join(first, "component").select(
        F.col("vec").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec") == F.col("component_id"), F.col("component_id").isNull() & (F.col("id") == F.col("first"))).alias("kept")
    )
    result = scratch.keep(result, "result")
    scratch.drop("rows", "prints", "classes", "found", "placed")
    return result


def _single(vectors: DataFrame, vector_col: str) -> bool:
    """Whether components are single precision, which travels at half the size without loss."""
    return vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
