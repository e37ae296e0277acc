"""Nearest segment of many points, for lines that are long beside the space between them.

Long lines cross many cells whatever the index, so pieces of them meet far more points than they are near
to. Here tiles hold about as many points each; a line goes to the tiles that it touches, as itself, and a
task splits its tile further in memory. Points whose nearest line may lie outside of their tile are tiled
once more, by the distance they know by then.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.session import scratch_path

TILE_POINTS = 30_000  # points of a tile, about
CHUNK_POINTS, CHUNK_LINES = 100_000, 200_000  # rows of a tile that one task takes at once
_LEAF_POINTS, _LEAF_LINES = 32, 64
_PROBES = 16  # lines tried at each split, to know a distance early
_SAMPLE = 512  # lines that every point tries, so that each knows some distance


@dataclass(frozen=True)
class Tiles:
    """Strips of longitude, each cut into bands of latitude; together they cover the plane."""

    strips: np.ndarray  # inner borders
    bands: tuple[np.ndarray, ...]  # inner borders, by strip

    def first(self) -> np.ndarray:
        """Number of the first tile of each strip."""
        return np.concatenate([[0], np.cumsum([len(b) + 1 for b in self.bands])]).astype(np.int64)

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        strip, first, tile = np.searchsorted(self.strips, x, side="right"), self.first(), np.zeros(len(x), np.int64)
        for s in np.unique(strip):
            rows = strip == s
            tile[rows] = first[s] + np.searchsorted(self.bands[s], y[rows], side="right")
        return tile

    def boxes(self) -> np.ndarray:
        """(tiles, 4): minx, miny, maxx, maxy; infinite at the rim."""
        edge = lambda v: np.concatenate([[-np.inf], v, [np.inf]])
        xs, out = edge(self.strips), []
        for s, band in enumerate(self.bands):
            ys = edge(band)
            out += [(xs[s], ys[i], xs[s + 1], ys[i + 1]) for i in range(len(ys) - 1)]
        return np.array(out)


def _tiles(points: DataFrame, n: int, tile_points: int) -> Tiles:
    """Borders by approximate quantiles; only they come to the driver, one per `tile_points` points."""
    many = max(1, round((n / tile_points) ** 0.5))
    cuts = lambda col, k: F.percentile_approx(col, [i / k for i in range(1, k)], 1000) if k > 1 else F.lit(None)
    strips = np.unique(np.array(points.agg(cuts("lon", many).alias("c")).first()[0] or [], float))
    numbered = points.select(F.size(F.filter(F.array(*[F.lit(float(s)) for s in strips]).cast("array<double>"), lambda b: b <= F.col("lon"))).alias("s"), "lat")
    found = numbered.groupBy("s").agg(cuts("lat", many).alias("c")).collect()
    bands = {r.s: np.unique(np.array(r.c or [], float)) for r in found}
    return Tiles(strips, tuple(bands.get(s, np.zeros(0)) for s in range(len(strips) + 1)))


def _distance(px, py, x1, y1, x2, y2):
    """Planar distance and closest place, by the same steps as `geo.closest_on_segment`."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(square == 0, 0.0, ((px - x1) * dx + (py - y1) * dy) / square)
    t = np.maximum(0.0, np.minimum(1.0, t))
    cx, cy = x1 + t * dx, y1 + t * dy
    return np.sqrt((cx - px) * (cx - px) + (cy - py) * (cy - py)), cx, cy


def _touching(lines: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Which lines may touch a box: their boxes meet, and the corners do not lie strictly on one side of them."""
    minx, miny, maxx, maxy = box
    x1, y1, x2, y2 = lines
    near = (np.maximum(x1, x2) >= minx) & (np.minimum(x1, x2) <= maxx) & (np.maximum(y1, y2) >= miny) & (np.minimum(y1, y2) <= maxy)
    if not np.isfinite(box).all():
        return near
    dx, dy, mx, my = x2 - x1, y2 - y1, (minx + maxx) / 2, (miny + maxy) / 2
    side = np.abs((mx - x1) * dy - (my - y1) * dx)
    reach = (maxx - minx) / 2 * np.abs(dy) + (maxy - miny) / 2 * np.abs(dx)
    # The margin absorbs the rounding of the products above.
    rounding = 1e-14 * (np.abs(x1) + np.abs(x2) + np.abs(y1) + np.abs(y2) + abs(mx) + abs(my)) * (np.abs(dx) + np.abs(dy))
    return near & (side <= reach + rounding)


class _Search:
    """The nearest of some lines (in order of their ids) to each of some points."""

    def __init__(self, x: np.ndarray, y: np.ndarray, lines: np.ndarray, bound: np.ndarray):
        self.x, self.y, self.lines = x, y, lines
        self.bound = bound.copy()  # some line is known to be as near; not necessarily one of these
        self.d, self.line = np.full(len(x), np.inf), np.full(len(x), -1, np.int64)

    def try_all(self, p: np.ndarray, g: np.ndarray) -> None:
        step = max(1, 500_000 // max(1, len(p)))
        for at in range(0, len(g), step):
            some = g[at : at + step]
            d, _, _ = _distance(self.x[p, None], self.y[p, None], *self.lines[:, some])
            low = d.min(axis=1)
            # The lines are in order of their ids, so the smallest number wins a tie.
            first = np.where(d == low[:, None], some[None, :], np.iinfo(np.int64).max).min(axis=1)
            better = (low < self.d[p]) | ((low == self.d[p]) & (first < self.line[p]))
            self.d[p[better]], self.line[p[better]] = low[better], first[better]
        self.bound[p] = np.minimum(self.bound[p], self.d[p])

    def run(self) -> None:
        # Numbers on a stack instead of recursion, as the depth is not bounded by the row counts.
        todo = [(np.arange(len(self.x)), np.arange(self.lines.shape[1]))]
        while todo:
            p, g = todo.pop()
            x, y = self.x[p], self.y[p]
            if len(g) > _LEAF_LINES:
                self.try_all(p, g[:: max(1, len(g) // _PROBES)][:_PROBES])
                pad = self.bound[p].max() * (1 + 1e-9) + 1e-12 * (1 + max(np.abs(x).max(), np.abs(y).max()))
                g = g[_touching(self.lines[:, g], (x.min() - pad, y.min() - pad, x.max() + pad, y.max() + pad))]
            if len(g) == 0:
                continue
            if len(p) <= _LEAF_POINTS or len(g) <= _LEAF_LINES:
                self.try_all(p, g)
                continue
            across = x if x.max() - x.min() >= y.max() - y.min() else y
            order = np.argsort(across, kind="stable")
            half = len(p) // 2
            todo += [(p[order[:half]], g), (p[order[half:]], g)]


def _as_lines(table: pa.Table) -> np.ndarray:
    return np.stack([table[c].to_numpy() for c in ("x1", "y1", "x2", "y2")]).astype(float)


def _nearest(points: pa.Table, lines: pa.Table, sample: pa.Table) -> pa.Table:
    """(lon, lat, best) of one group; the sample is tried as well."""
    names = ["nearest_id", "x1", "y1", "x2", "y2"]
    lines = pa.concat_tables([lines.select(names), sample.select(names)]).combine_chunks()
    # An id that is missing comes first, as among structs in Spark.
    lines = lines.take(pa.compute.sort_indices(lines, sort_keys=[("nearest_id", "ascending")], null_placement="at_start"))
    ends, x, y = _as_lines(lines), points["lon"].to_numpy(), points["lat"].to_numpy()
    search = _Search(x, y, ends, points["bound"].to_numpy())
    if len(x) and ends.shape[1]:
        search.run()
    found = search.line >= 0
    at = search.line[found]
    d, cx, cy = _distance(x[found], y[found], *ends[:, at])
    best = pa.StructArray.from_arrays(
        [pa.array(d), lines["nearest_id"].combine_chunks().take(pa.array(at)), pa.array(cx), pa.array(cy)], ["d", "nearest_id", "x", "y"]
    )
    return pa.table({"lon": x[found], "lat": y[found], "best": best})


def _round(points: DataFrame, lines: DataFrame, boxes: np.ndarray, sample: pa.Table, result: T.StructType) -> DataFrame:
    """(lon, lat, best) of points (tile, lon, lat, bound) among the lines that touch the boxes of their tiles."""
    spark = points.sparkSession
    kind = T.StructType([T.StructField("tile", T.LongType()), *[lines.schema[c] for c in ("nearest_id", "x1", "y1", "x2", "y2")]])
    columns = {}  # tiles whose boxes share their range of longitudes
    for i, b in enumerate(boxes):
        columns.setdefault((b[0], b[2]), []).append((i, tuple(b)))

    def spread(batches):
        for batch in batches:
            ends = _as_lines(pa.Table.from_batches([batch]))
            low, high = np.minimum(ends[0], ends[2]), np.maximum(ends[0], ends[2])
            for (minx, maxx), tiles in columns.items():
                rows = np.flatnonzero((high >= minx) & (low <= maxx))
                mine = ends[:, rows]
                hits = [(i, rows[_touching(mine, box)]) for i, box in tiles]
                at = np.concatenate([r for _, r in hits])
                tile = np.concatenate([np.full(len(r), i, np.int64) for i, r in hits])
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(tile), *taken.columns], names=kind.names)

    spreads = lines.select("nearest_id", "x1", "y1", "x2", "y2").mapInArrow(spread, kind)
    # Tiles with too many rows of a side are taken in chunks, each chunk of points with each of lines.
    crowd = points.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK_POINTS).select("tile", F.ceil(F.col("n") / CHUNK_POINTS).alias("pk"), F.lit(1).cast("long").alias("lk"))
    bundle = spreads.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK_LINES).select("tile", F.lit(1).cast("long").alias("pk"), F.ceil(F.col("n") / CHUNK_LINES).alias("lk"))
    chunks = {r.tile: (r.pk, r.lk) for r in crowd.unionByName(bundle).groupBy("tile").agg(F.max("pk").alias("pk"), F.max("lk").alias("lk")).collect()}
    pick = lambda k: F.create_map(*[F.lit(v) for t, c in chunks.items() for v in (int(t), int(c[k]))])[F.col("tile")] if chunks else F.lit(None)
    parts = [F.coalesce(pick(k).cast("long"), F.lit(1).cast("long")) for k in (0, 1)]
    turn = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    p = points.withColumn("pi", F.pmod(F.xxhash64("lon", "lat"), parts[0])).withColumn("li", F.explode(turn(parts[1])))
    g = spreads.withColumn("li", F.pmod(F.xxhash64("x1", "y1", "x2", "y2"), parts[1])).withColumn("pi", F.explode(turn(parts[0])))
    keys = ["tile", "pi", "li"]
    found = p.groupBy(*keys).cogroup(g.groupBy(*keys)).applyInArrow(lambda a, b: _nearest(a, b, sample), result)
    return found.groupBy("lon", "lat").agg(F.min("best").alias("best"))


def nearest_lines(points: DataFrame, lines: DataFrame, tile_points: int = TILE_POINTS) -> DataFrame:
    """(lon, lat, best): the nearest segment of each distinct place of `points` (lon, lat), not null.

    `lines`: nearest_id, x1, y1, x2, y2, not null but for the id. `best` holds d, nearest_id, x, y: the planar
    distance, the segment (the smallest id of those equally near) and its closest place. Empty without lines.
    """
    spark, path = points.sparkSession, scratch_path(points.sparkSession, "nearest-lines")
    points.select("lon", "lat").distinct().write.parquet(f"{path}/points")
    lines.select("nearest_id", "x1", "y1", "x2", "y2").write.parquet(f"{path}/lines")
    places, lines = (spark.read.parquet(f"{path}/{name}") for name in ("points", "lines"))
    best = T.StructType([T.StructField("d", T.DoubleType()), T.StructField("nearest_id", lines.schema["nearest_id"].dataType), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    result = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()), T.StructField("best", best)])
    n = places.count()
    sample = lines.limit(_SAMPLE).toArrow()
    if not n or not sample.num_rows:
        return spark.createDataFrame([], result)

    def tiled(rows: DataFrame, tiles: Tiles) -> DataFrame:
        kind = T.StructType([T.StructField(c, t) for c, t in (("tile", T.LongType()), ("lon", T.DoubleType()), ("lat", T.DoubleType()), ("bound", T.DoubleType()))])

        def number(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(tiles.of(b["lon"].to_numpy(), b["lat"].to_numpy())), b["lon"], b["lat"], b["bound"]], names=kind.names)

        return rows.select("lon", "lat", "bound").mapInArrow(number, kind)

    tiles = _tiles(places, n, tile_points)
    boxes = tiles.boxes()
    _round(tiled(places.withColumn("bound", F.lit(float("inf"))), tiles), lines, boxes, sample, result).write.parquet(f"{path}/first")
    first = spark.read.parquet(f"{path}/first")

    # A place is done if all that lies as near as the line found is inside its tile.
    flags = T.StructType([*result.fields, T.StructField("done", T.BooleanType())])

    def judge(batches):
        for b in batches:
            x, y = b["lon"].to_numpy(), b["lat"].to_numpy()
            d = pa.compute.struct_field(b["best"], "d").to_numpy() * (1 + 1e-9) + 1e-12 * (1 + np.maximum(np.abs(x), np.abs(y)))
            box = boxes[tiles.of(x, y)]
            done = (x - d > box[:, 0]) & (y - d > box[:, 1]) & (x + d < box[:, 2]) & (y + d < box[:, 3])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(done)], names=flags.names)

    first.mapInArrow(judge, flags).write.partitionBy("done").parquet(f"{path}/judged")
    judged = spark.read.schema(flags).parquet(f"{path}/judged")
    done, rest = judged.where("done").drop("done"), judged.where("not done").select("lon", "lat", F.col("best.d").alias("bound"))
    left = rest.count()
    if not left:
        return done
    again = tiled(rest, _tiles(rest, left, tile_points))
    pad = F.col("bound") * (1 + 1e-9) + F.lit(1e-12) * (1 + F.greatest(F.abs("lon"), F.abs("lat")))
    reach = again.groupBy("tile").agg(F.min(F.col("lon") - pad).alias("a"), F.min(F.col("lat") - pad).alias("b"), F.max(F.col("lon") + pad).alias("c"), F.max(F.col("lat") + pad).alias("d"))
    found = {r.tile: (r.a, r.b, r.c, r.d) for r in reach.collect()}
    nowhere = (np.inf, np.inf, -np.inf, -np.inf)
    second = np.array([found.get(i, nowhere) for i in range(max(found) + 1)])
    return done.unionByName(_round(again, lines, second, sample, result))
