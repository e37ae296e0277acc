"""How many other points lie within a radius, without listing the pairs.

The places are tiled by their number; a task counts its tile's neighbours in memory. Places stand on the unit
sphere (at their reduced latitude for the spheroid), where a chord bounds the distance: most groups of
places lie wholly within the radius or beyond it and are counted by their sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions import geo
from terrawatt.operators.nearest_lines import TILE_POINTS, _tiles
from terrawatt.session import scratch_path

CHUNK_PLACES = 300_000  # places of a side of a tile that one task takes at once
_LEAF = 32


def _metres(lon1, lat1, lon2, lat2, metric: str) -> np.ndarray:
    """`geo.spheroid_m` and `geo.haversine_m` on arrays."""
    b1, b2 = np.radians(lat1), np.radians(lat2)
    if metric == "spheroid":
        b1, b2 = (np.arctan((1 - geo.WGS84_F) * np.tan(b)) for b in (b1, b2))
    h = np.sin((b2 - b1) / 2) ** 2 + np.cos(b1) * np.cos(b2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    half = np.arcsin(np.minimum(1.0, np.sqrt(h)))
    if metric == "haversine":
        return 2 * geo.EARTH_RADIUS * half
    arc, p, q = 2 * half, (b1 + b2) / 2, (b2 - b1) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (arc - np.sin(arc)) * np.where(np.cos(half) == 0, 0.0, (np.sin(p) * np.cos(q)) ** 2 / np.cos(half) ** 2)
        y = (arc + np.sin(arc)) * np.where(np.sin(half) == 0, 0.0, (np.cos(p) * np.sin(q)) ** 2 / np.sin(half) ** 2)
    return geo.WGS84_A * (arc - geo.WGS84_F / 2 * (x + y))


def _on_sphere(lon: np.ndarray, lat: np.ndarray, metric: str) -> np.ndarray:
    """(3, n) unit vectors."""
    b, a = np.radians(lat), np.radians(lon)
    if metric == "spheroid":
        b = np.arctan((1 - geo.WGS84_F) * np.tan(b))
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)])


def _chords(radius_m: float, metric: str) -> tuple[float, float]:
    """Chords up to which a place is surely within the radius, and beyond which it surely is not."""
    # The flattening takes at most 2 f off an arc below a radian; wider radii are measured pair by pair.
    arc = radius_m / (geo.EARTH_RADIUS if metric == "haversine" else geo.WGS84_A)
    low, high = arc * (1 - 1e-9), arc * (1 + 1e-9 + (0 if metric == "haversine" else 2 * geo.WGS84_F))
    if high > 0.9:
        return -1.0, 3.0
    return 2 * np.sin(low / 2) - 4e-15, 2 * np.sin(high / 2) + 4e-15


class _Groups:
    """Places split by halves: each node has its rows, box and weight."""

    def __init__(self, at: np.ndarray, weight: np.ndarray):
        self.rows, self.low, self.high, self.weight, self.child = [], [], [], [], []
        todo = [(np.arange(at.shape[1]), -1)]
        while todo:
            rows, parent = todo.pop()
            mine = at[:, rows]
            low, high = mine.min(axis=1), mine.max(axis=1)
            number = len(self.rows)
            self.rows.append(rows)
            self.low.append(low)
            self.high.append(high)
            self.weight.append(weight[rows].sum())
            self.child.append([])
            if parent >= 0:
                self.child[parent].append(number)
            if len(rows) > _LEAF:
                order = np.argsort(mine[np.argmax(high - low)], kind="stable")
                todo += [(rows[order[: len(rows) // 2]], number), (rows[order[len(rows) // 2 :]], number)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.weight = np.array(self.weight)
        # Leaves have no children: -1.
        self.child = np.array([c or [-1, -1] for c in self.child])

    def leaves(self):
        return (self.rows[i] for i in np.flatnonzero(self.child[:, 0] < 0))


def _count(mine: pa.Table, others: pa.Table, radius_m: float, metric: str) -> pa.Table:
    """(lon, lat, n) of places of one group: the weight of the others within the radius, itself included."""
    lon, lat = mine["lon"].to_numpy(), mine["lat"].to_numpy()
    total = np.zeros(len(lon), np.int64)
    if len(lon) and others.num_rows:
        olon, olat, weight = others["lon"].to_numpy(), others["lat"].to_numpy(), others["w"].to_numpy()
        at, around = _on_sphere(lon, lat, metric), _on_sphere(olon, olat, metric)
        tree, (within, beyond) = _Groups(around, weight), _chords(radius_m, metric)
        for rows in _Groups(at, np.ones(len(lon), np.int64)).leaves():
            low, high = at[:, rows].min(axis=1), at[:, rows].max(axis=1)
            front, near = np.array([0]), []
            while len(front):
                gap = np.maximum(0.0, np.maximum(low - tree.high[front], tree.low[front] - high))
                reach = np.maximum(high - tree.low[front], tree.high[front] - low)
                least, most = np.sqrt((gap * gap).sum(axis=1)), np.sqrt((reach * reach).sum(axis=1))
                total[rows] += tree.weight[front[most <= within]].sum()
                front = front[(most > within) & (least <= beyond)]
                leaf = tree.child[front, 0] < 0
                near += front[leaf].tolist()
                front = tree.child[front[~leaf]].ravel()
            if not near:
                continue
            some = np.concatenate([tree.rows[i] for i in near])
            step = max(1, 1_000_000 // len(rows))
            for k in range(0, len(some), step):
                part = some[k : k + step]
                apart = np.sqrt(sum((at[j, rows][:, None] - around[j, part][None, :]) ** 2 for j in range(3)))
                hit = apart <= within
                i, j = np.nonzero(~hit & (apart <= beyond))
                hit[i, j] = _metres(lon[rows[i]], lat[rows[i]], olon[part[j]], olat[part[j]], metric) <= radius_m
                total[rows] += hit @ weight[part]
    return pa.table({"lon": lon, "lat": lat, "n": total})


def count_within(places: DataFrame, radius_m: float, metric: str = "spheroid", tile_points: int = TILE_POINTS) -> DataFrame:
    """(lon, lat, n): the sum of `w` over all places within the radius of each, itself included.

    `places`: lon, lat (not null, each place once) and w long.
    """
    spark, path = places.sparkSession, scratch_path(places.sparkSession, "crowding")
    places.select("lon", "lat", "w").write.parquet(path)
    places = spark.read.parquet(path)
    result, n = "lon double, lat double, n long", places.count()
    if not n:
        return spark.createDataFrame([], result)
    tiles, beyond = _tiles(places, n, tile_points), _chords(radius_m, metric)[1]
    kind = T.StructType([T.StructField("tile", T.LongType()), *[places.schema[c] for c in ("lon", "lat", "w")]])
    box = T.StructType([T.StructField("tile", T.LongType()), *[T.StructField(f"{c}{s}", T.DoubleType()) for s in "ab" for c in "xyz"]])

    def number(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tiles.of(b["lon"].to_numpy(), b["lat"].to_numpy())), *b.columns], names=kind.names)

    mine = places.mapInArrow(number, kind)

    def boxed(batches):
        for b in batches:
            tile, at = b["tile"].to_numpy(), _on_sphere(b["lon"].to_numpy(), b["lat"].to_numpy(), metric)
            for t in np.unique(tile):
                some = at[:, tile == t]
                yield pa.RecordBatch.from_arrays([pa.array([t])] + [pa.array([float(v)]) for v in (*some.min(axis=1), *some.max(axis=1))], names=box.names)

    sides = [f(c + s).alias(c + s) for s, f in (("a", F.min), ("b", F.max)) for c in "xyz"]
    boxes = mine.mapInArrow(boxed, box).groupBy("tile").agg(*sides, F.count(F.lit(1)).alias("_")).drop("_").collect()
    numbers, edges = [r.tile for r in boxes], np.array([list(r)[1:] for r in boxes])

    def spread(batches):
        for b in batches:
            at = _on_sphere(b["lon"].to_numpy(), b["lat"].to_numpy(), metric)
            for t, e in zip(numbers, edges):
                gap = np.maximum(0.0, np.maximum(e[:3, None] - at, at - e[3:, None]))
                rows = np.flatnonzero((gap * gap).sum(axis=0) <= beyond * beyond)
                if len(rows):
                    taken = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t, np.int64)), *taken.columns], names=kind.names)

    others = places.mapInArrow(spread, kind)
    # A tile with too many neighbours takes them in chunks.
    many = others.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / CHUNK_PLACES).alias("k")).where("k > 1").collect()
    turns = F.coalesce(F.create_map(*[F.lit(v) for r in many for v in (r.tile, r.k)])[F.col("tile")], F.lit(1).cast("long")) if many else F.lit(1).cast("long")
    a = mine.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), turns - 1)))
    b = others.withColumn("i", F.pmod(F.xxhash64("lon", "lat"), turns))
    counted = a.groupBy("tile", "i").cogroup(b.groupBy("tile", "i")).applyInArrow(lambda x, y: _count(x, y, radius_m, metric), result)
    return counted.groupBy("lon", "lat").agg(F.sum("n").alias("n"))


def others_within(points: DataFrame, radius_m: float, metric: str = "spheroid") -> DataFrame:
    """(id, n): the points of other ids within the radius, summed over the rows of an id; ids without any are left out.

    `points`: id, lon, lat; rows without an id or a place take no part.
    """
    from terrawatt.operators.spatial import join_radius

    known = points.where("id IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    rows = known.groupBy("id", "lon", "lat").agg(F.count(F.lit(1)).alias("w"))
    around = count_within(rows.groupBy("lon", "lat").agg(F.sum("w").alias("w")), radius_m, metric)
    near = rows.join(around, ["lon", "lat"]).groupBy("id").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), F.sum(F.col("w") * F.col("w")).alias("own"), F.count(F.lit(1)).alias("places")
    )
    # What an id counted of itself goes: its own place, and its other places within the radius.
    wide = rows.join(near.where("places > 1").select("id"), "id", "left_semi").withColumn("id", F.struct("id", "lon", "lat", "w"))
    wide = wide.withColumns({"lon": F.col("id.lon"), "lat": F.col("id.lat")})
    same = join_radius(wide, wide, radius_m, metric).where("a_id.id = b_id.id AND (a_id.lon <> b_id.lon OR a_id.lat <> b_id.lat)")
    same = same.groupBy(F.col("a_id.id").alias("id")).agg(F.sum(F.col("a_id.w") * F.col("b_id.w")).alias("self"))
    left = F.col("n") - F.col("own") - F.coalesce("self", F.lit(0))
    return near.join(same, "id", "left").select("id", left.alias("n")).where("n > 0")
