"""Exact top-k search by inner product with a pivot table.

Distances of every vector to a set of pivots are computed once. By the triangle inequality they bound
the distance of a query to a vector from below, and with the vector's length the inner product from
above. Blocks of near vectors have bounds of their own. Each query first searches its most promising
block, which gives it a score to beat, then every block whose bound is not below that score; inside a
block, vectors are evaluated in the order of their bounds until no bound reaches the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch
from terrawatt.llm.shipping import ship, shipped
from terrawatt.llm.textcore import ragged
from terrawatt.llm.units import each_unit

K = 5
SCALE = 256.0
#: Pivots, and the rows in expectation that they are picked from (documented bound of the fit).
PIVOTS, PIVOT_ROWS = 48, 4096
#: Vectors per block, queries that meet a block at once, blocks whose bounds are looked at together.
BLOCK, QUERIES, TILE = 1024, 1024, 4096
#: Vectors evaluated between two looks at the bounds.
STEP = 32
#: Scores and squared distances below this are exact in double precision.
_EXACT = 2.0**53


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dim, x) of the usable rows: components times SCALE, rounded down, as bytes of 64-bit integers."""
    for batch in batches:
        column = batch.column("v")
        flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
        size = np.asarray(pc.list_value_length(column).fill_null(0)).astype(np.int64)
        first = np.cumsum(size) - size
        usable = np.asarray(column.is_valid())
        if len(flat):
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            usable &= bad[first + size] == bad[first]
        rows = np.flatnonzero(usable)
        with np.errstate(over="ignore"):
            scaled = np.floor(SCALE * np.where(np.isfinite(flat), flat, 0.0))
        ends = np.append(0, np.cumsum(size[rows]))
        kept = scaled[ragged(first[rows], size[rows])] if len(rows) else scaled[:0]
        owner = np.repeat(np.arange(len(rows)), size[rows])
        if (np.abs(kept) >= 2.0**31).any() or (np.bincount(owner, kept * kept, minlength=len(rows)) >= _EXACT / 8).any():
            raise ValueError("a vector is too long for exact scores")
        x = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((ends * 8).astype(np.int32)), pa.py_buffer(kept.astype("<i8"))])
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.array(size[rows].astype(np.int32)), x], names=["id", "dim", "x"])


def _matrix(column: pa.Array | pa.ChunkedArray, kind: str = "<i8") -> np.ndarray:
    """Equally long binary values as a matrix of doubles."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(float)


def farthest(x: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` distinct rows, each the farthest from those before it, from the row farthest from the mean."""
    far = ((x - x.mean(0)) ** 2).sum(1)
    chosen = [int(far.argmax())]
    least = np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        least = np.minimum(least, ((x - x[chosen[-1]]) ** 2).sum(1))
        if least.max() == 0:
            break
        chosen.append(int(least.argmax()))
    return x[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots; sums of squares are exact, roots are rounded."""
    squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def score_bound(norm: np.ndarray | float, other: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product of two vectors of these squared lengths whose distance is at least `distance`, safe against rounding."""
    reach = np.maximum(distance * (1 - 1e-9) - 1e-6, 0.0)
    return np.floor((norm + other - reach * reach) / 2 + (norm + other) * 1e-12 + 1e-3)


class Pivots:
    """The pivots of each length of vectors."""

    def __init__(self, by_dim: dict[int, np.ndarray]):
        self.by_dim = by_dim

    def placed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the squared length, the distances to the pivots and the nearest pivot."""
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = _matrix(part.column("x")) if dim else np.zeros((len(part), 0))
                far = pivot_distances(x, self.by_dim.get(dim, np.zeros((1, dim))))
                table = pa.array([r.tobytes() for r in far], pa.binary())
                values = [*part.columns, pa.array((x * x).sum(1).astype(np.int64)), table, pa.array(far.argmin(1))]
                yield pa.RecordBatch.from_arrays(values, names=[*part.schema.names, "norm", "far", "cell"])


def _summary(held: pa.Table) -> pa.RecordBatch:
    """Bounds of one block: least and greatest distance to each pivot, greatest squared length."""
    far = _matrix(held.column("far"), "<f8")
    one = held.slice(0, 1)
    values = [one.column(c).combine_chunks() for c in ("block", "dim")] + [pa.array([int(np.asarray(held.column("norm")).max())])]
    values += [pa.array([edge.tobytes()], pa.binary()) for edge in (far.min(0), far.max(0))]
    return pa.RecordBatch.from_arrays(values, names=["block", "dim", "norm", "low", "high"])


def _promising(first: bool):
    """Blocks of a tile that a query has to search: the best one (`first`), or those whose bound reaches the query's score to beat."""

    def work(held: pa.Table) -> pa.RecordBatch:
        query = np.asarray(held.column("query"))
        blocks, queries = (held.filter(pa.array(query == side)) for side in (False, True))
        names = ["id", "block", "bound"]
        if not len(blocks) or not len(queries):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=names)
        low, high, far = _matrix(blocks.column("low"), "<f8"), _matrix(blocks.column("high"), "<f8"), _matrix(queries.column("far"), "<f8")
        own, norm = np.asarray(blocks.column("block")), np.asarray(blocks.column("norm")).astype(float)
        ids, mine = np.asarray(queries.column("id")), np.asarray(queries.column("norm")).astype(float)
        home, beat = (np.asarray(queries.column(c).fill_null(-1)) for c in ("home", "beat"))
        some = np.asarray(queries.column("beat").is_valid())
        out = []
        for i in range(len(ids)):
            bound = score_bound(mine[i], norm, np.maximum(np.maximum(low - far[i], far[i] - high).max(1), 0.0))
            at = np.array([bound.argmax()]) if first else np.flatnonzero((own != home[i]) & ((bound >= beat[i]) | (not some[i])))
            out.append((np.full(len(at), ids[i]), own[at], bound[at].astype(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    return work


def _searched(k: int):
    """(id, score, first, class) of the best k classes of one block for each of its queries, by elimination; ties go to the smaller first id."""

    def work(held: pa.Table) -> pa.RecordBatch:
        side = np.asarray(held.column("query"))
        rows, queries = (held.filter(pa.array(side == s)) for s in (False, True))
        out = [(np.zeros(0, np.int64),) * 4]
        if len(rows) and len(queries):
            x, y = _matrix(rows.column("x")), _matrix(queries.column("x"))
            table, far = _matrix(rows.column("far"), "<f8"), _matrix(queries.column("far"), "<f8")
            norm, mine = (np.asarray(t.column("norm")).astype(float) for t in (rows, queries))
            ids, firsts, names = np.asarray(rows.column("id")), np.asarray(rows.column("first")), np.asarray(queries.column("id"))
            beat = np.asarray(queries.column("beat").fill_null(-(2**62))).astype(float)
            for i in range(len(names)):
                bound = score_bound(mine[i], norm, np.abs(table - far[i]).max(1))
                order = np.flatnonzero(bound >= beat[i])
                order = order[np.argsort(-bound[order], kind="stable")]
                least, best, who = beat[i], np.zeros(0), np.zeros(0, np.int64)
                for at in range(0, len(order), STEP):
                    if bound[order[at]] < least:
                        break
                    part = order[at : at + STEP]
                    best, who = np.append(best, x[part] @ y[i]), np.append(who, part)
                    if len(best) > k:
                        top = np.lexsort((ids[who], firsts[who], -best))[:k]
                        best, who = best[top], who[top]
                    if len(best) == k:
                        least = max(least, best.min())
                out.append((np.full(len(who), names[i]), best.astype(np.int64), firsts[who], ids[who]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["id", "score", "first", "class"])

    return work


def _top(df: DataFrame, keys: list[str], k: int, by: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, pivot_rows: int = PIVOT_ROWS, block: int = BLOCK,
    queries_at_once: int = QUERIES, tile: int = TILE,
) -> DataFrame:
    """(query_id, rank, id, score): for each row with `is_query`, the `k` other rows of highest integer inner product, ties to smaller ids.

    A component x counts as floor(256 x). Vectors that are null or hold null or non-finite components take
    no part, nor do rows without id; only vectors of equal length meet, a vector of zeros is like any
    other. Fewer than k rows are given where there are no more. Rows that repeat an id are rows of their own, and a
    query meets those with its own id never. A vector of components so large that scores were not exact raises an error.

    Equal vectors are one class, searched once, with its k + 1 smallest ids. A class belongs to the cell of its nearest pivot;
    a cell is cut into blocks of about `block` classes. Only blocks and vectors whose bound is below a score already reached are left
    out, so the result is exact whatever the pivots. A block with many queries meets them in parts; bounds of
    blocks are looked at in tiles.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "pivots")
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("id IS NOT NULL")
    whole = slim.select("id", "v").mapInArrow(_integers, "id long, dim int, x binary")
    rows = scratch.keep(whole, "rows")
    asks = scratch.keep(slim.where("asks").select("id").distinct(), "asks")
    members = _top(rows.groupBy("dim", "x", "id").agg(F.count(F.lit(1)).alias("times")), ["dim", "x"], k + 1, [F.col("id").asc()])
    classes = members.groupBy("dim", "x").agg(F.array_sort(F.collect_list(F.struct("id", "times"))).alias("members"))
    classes = scratch.keep(classes.withColumn("first", F.col("members")[0]["id"]).withColumn("class", F.monotonically_increasing_id()), "classes")
    asking = rows.join(asks, "id").select("dim", "x", "id").distinct().join(classes.select("dim", "x", "class"), ["dim", "x"]).select("class", F.col("id").alias("query_id"))
    asking = scratch.keep(asking, "asking")

    total = max(1, classes.count())
    sample = classes.where(F.pmod(F.xxhash64("x", F.lit(7)), F.lit(1 << 30)) < min(1.0, pivot_rows / total) * (1 << 30)).select("dim", "x").toPandas()
    parcel = ship(spark, Pivots({int(d): farthest(_matrix(pa.array(g.x)), pivots) for d, g in sample.sort_values("x").groupby("dim") if d}))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return shipped(parcel).placed(batches)

    points = classes.select(F.col("class").alias("id"), "first", "dim", "x").mapInArrow(placed, "id long, first long, dim int, x binary, norm long, far binary, cell long")
    points = scratch.keep(points, "points")
    sizes = points.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"))
    number = F.xxhash64("dim", "cell", F.pmod(F.xxhash64("id"), F.col("parts")))
    points = scratch.keep(points.join(sizes, ["dim", "cell"]).select("id", "first", "dim", "x", "norm", "far", number.alias("block")), "blocks")
    summary = points.select("block", "dim", "norm", "far").repartition("block").sortWithinPartitions("block").mapInArrow(each_unit(["block"], _summary), "block long, dim int, norm long, low binary, high binary")
    summary = scratch.keep(summary, "summary")
    of_dim = summary.groupBy("dim").agg(F.count(F.lit(1)).alias("blocks")).select("dim", F.ceil(F.col("blocks") / F.lit(tile)).cast("int").alias("tiles"))
    query = scratch.keep(points.join(asking.select(F.col("class").alias("id")).distinct(), "id").drop("block"), "query")
    many = query.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(queries_at_once)).cast("int").alias("shares"))
    none = lambda kind: F.lit(None).cast(kind)

    def blocks_for(asked: DataFrame, first: bool) -> DataFrame:
        """(id, block, bound), from every tile of bounds with every share of the queries of that length."""
        grid = of_dim.join(many, "dim")
        mine = asked.join(grid, "dim").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        theirs = summary.join(grid, "dim").withColumn("tile", F.pmod(F.xxhash64("block"), F.col("tiles")).cast("int")).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        left = mine.select("dim", "tile", "share", F.lit(True).alias("query"), "id", "norm", "far", "home", "beat", none("long").alias("block"), none("binary").alias("low"), none("binary").alias("high"))
        right = theirs.select("dim", "tile", "share", F.lit(False).alias("query"), none("long").alias("id"), "norm", none("binary").alias("far"), none("long").alias("home"), none("long").alias("beat"), "block", "low", "high")
        keys = ["dim", "tile", "share"]
        return left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each_unit(keys, _promising(first)), "id long, block long, bound long")

    def search(pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """(id, score, first, class) of the best classes of each block for its queries."""
        shares = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(queries_at_once)).cast("int").alias("shares"))
        share = F.pmod(F.xxhash64("id", "block"), F.col("shares")).cast("int").alias("share")
        mine = pairs.select("id", "block").join(shares, "block").join(asked, "id").select("block", share, F.lit(True).alias("query"), "id", none("long").alias("first"), "x", "norm", "far", "beat")
        theirs = points.join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        theirs = theirs.select("block", "share", F.lit(False).alias("query"), "id", "first", "x", "norm", "far", none("long").alias("beat"))
        return mine.unionByName(theirs).repartition("block", "share").sortWithinPartitions("block", "share").mapInArrow(each_unit(["block", "share"], _searched(k + 1)), "id long, score long, first long, class long")

    start = query.withColumn("home", none("long")).withColumn("beat", none("long"))
    home = blocks_for(start, True).groupBy("id").agg(F.max(F.struct("bound", "block")).alias("best")).select("id", F.col("best.block").alias("block"))
    home = scratch.keep(home, "home")
    found = scratch.keep(search(home, start), "found1")
    # k + 1 classes, the query's own among them, hold k other rows at least.
    beat = found.groupBy("id").agg(F.min("score").alias("beat"), F.count(F.lit(1)).alias("n")).where(F.col("n") > k).drop("n")
    again = scratch.keep(query.join(home.withColumnRenamed("block", "home"), "id").join(beat, "id", "left"), "again")
    more = scratch.keep(search(scratch.keep(blocks_for(again, False), "pairs"), again), "found2")
    best = _top(found.union(more), ["id"], k + 1, [F.col("score").desc(), F.col("first").asc(), F.col("class").asc()])

    met = best.select(F.col("id").alias("asked"), "score", "class").join(classes.select("class", "members"), "class").select("asked", "score", F.inline("members"))
    pairs = met.join(asking.withColumnRenamed("class", "asked"), "asked").where("id <> query_id").withColumn("again", F.explode(F.sequence(F.lit(1), F.least(F.col("times"), F.lit(k)).cast("int"))))
    result = _top(pairs, ["query_id", "asked"], k, [F.col("score").desc(), F.col("id").asc()])
    result = scratch.keep(result.select("query_id", "rank", F.col("id").alias(id_col), "score"), "result")
    scratch.drop("rows", "asks", "asking", "classes", "points", "blocks", "summary", "query", "home", "found1", "again", "pairs", "found2")
    return result
