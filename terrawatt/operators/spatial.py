"""Spatial joins and lookups.

Joins block both sides on grid cells and refine exactly, so no pair of far-apart rows ever meets.
Column conventions: points `id, lon, lat`; rectangles `id, minx, miny, maxx, maxy`; segments
`id, x1, y1, x2, y2`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrawatt.functions import geo, shapes
from terrawatt.operators.nearest_lines import nearest_lines
from terrawatt.operators.skew import balanced_join
from terrawatt.session import scratch_path

METRIC = {"spheroid": geo.spheroid_m, "haversine": geo.haversine_m}


# --- radius -----------------------------------------------------------------------------


def _radius_box(lat: Column, radius_m: float) -> tuple[Column, Column]:
    """Half height and half width in degrees of a box that holds the radius; 1 % wider to be safe."""
    dlat = radius_m * 1.01 / 110_574.0
    widest = F.least(F.lit(89.9), F.abs(lat) + dlat)
    return F.lit(dlat), F.lit(radius_m * 1.01 / 111_320.0) / F.cos(F.radians(widest))


def _near_lon(lon: float, half: Column, low: Column, high: Column, lat_limit: Column) -> Column:
    """Whether the longitudes low..high come within `half` degrees of `lon`, on either side of ±180.

    Where the box holds a pole (`lat_limit` is at or beyond 90 degrees) every longitude does.
    """
    meets = lambda shift: (high + shift >= F.lit(lon) - half) & (low + shift <= F.lit(lon) + half)
    return (lat_limit >= 90.0) | meets(0.0) | meets(360.0) | meets(-360.0)


def within_radius(df: DataFrame, lon: float, lat: float, radius_m: float, metric: str = "spheroid") -> DataFrame:
    """Points at most `radius_m` from a location. The box test comes first and can skip row groups."""
    dlat, dlon = _radius_box(F.lit(float(lat)), radius_m)
    near = F.col("lat").between(F.lit(lat) - dlat, F.lit(lat) + dlat)
    near = near & _near_lon(float(lon), dlon, F.col("lon"), F.col("lon"), F.lit(abs(float(lat))) + dlat)
    d = METRIC[metric](F.col("lon"), F.col("lat"), F.lit(float(lon)), F.lit(float(lat)))
    return df.where(near).withColumn("distance_m", d).where(F.col("distance_m") <= radius_m)


def rect_distance_m(x: Column, y: Column, rect: tuple, metric: str = "spheroid") -> Column:
    """Metres from a point to the planar closest point of a filled rectangle; 0 inside."""
    p = geo.closest_on_rect(x, y, *rect)
    return METRIC[metric](x, y, p["x"], p["y"])


_RECT = ("minx", "miny", "maxx", "maxy")


def buildings_within_radius(
    geoms: DataFrame, lon: float, lat: float, radius_m: float, key: str = "building_id", metric: str = "spheroid"
) -> DataFrame:
    """Ids of rectangles at most `radius_m` from a location."""
    dlat, dlon = _radius_box(F.lit(float(lat)), radius_m)
    x, y = F.lit(float(lon)), F.lit(float(lat))
    near = (F.col("maxy") >= y - dlat) & (F.col("miny") <= y + dlat)
    near = near & _near_lon(float(lon), dlon, F.col("minx"), F.col("maxx"), F.lit(abs(float(lat))) + dlat)
    # The planar closest point may lie on the other side of ±180, so the location is tried there too.
    d = F.least(*[rect_distance_m(x + shift, y, tuple(F.col(c) for c in _RECT), metric) for shift in (0.0, 360.0, -360.0)])
    return geoms.where(near & (d <= radius_m)).select(key)


def features_within_radius(
    geoms: DataFrame, risk: DataFrame, lon: float, lat: float, radius_m: float, metric: str = "spheroid"
) -> DataFrame:
    """(building_id, risk_score) of the buildings near a location; the score may be missing."""
    near = buildings_within_radius(geoms, lon, lat, radius_m, metric=metric)
    return near.join(risk.select("building_id", "risk_score"), "building_id", "left")


def join_radius(
    a: DataFrame, b: DataFrame, radius_m: float, metric: str = "spheroid", max_lat: float = 85.0,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """(a_id, b_id, distance_m) of all pairs of points at most `radius_m` apart.

    Rows are blocked on latitude bands of the radius' height; within a band, cells are as wide as
    the radius at the band's most poleward latitude. Each b row goes to its own cell, each a row
    looks into the neighbouring cells, so a pair meets once. Dense cells are split. Pairs that meet go
    by the chord between their places first (1 % wider, as the spheroid differs), which takes no trigonometry; only
    those left are measured.
    """
    step = radius_m * 1.01 / 110_574.0
    band = lambda lat: F.floor((lat + 90.0) / step).cast("long")

    def cells_around(band_no: Column) -> Column:
        # Number of equal cells around the globe, each at least as wide as the radius anywhere in
        # the band and its two neighbours; polar bands are one cell.
        low = band_no * step - 90.0
        worst = F.greatest(F.abs(low - step), F.abs(low + 2 * step))
        width = F.lit(radius_m * 1.01 / 111_320.0) / F.cos(F.radians(F.least(worst, F.lit(max_lat))))
        return F.when(worst > max_lat, 1).otherwise(F.greatest(F.lit(1), F.floor(360.0 / width))).cast("long")

    def cell(lon: Column, n: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / 360.0 * n).cast("long"), n)

    def placed(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(F.col("id").alias(f"{side}_id"), F.col("lon").alias(f"{side}_lon"), F.col("lat").alias(f"{side}_lat"))
        lon, lat = F.radians(f"{side}_lon"), F.radians(f"{side}_lat")
        return rows.withColumns({f"_{side}x": F.cos(lat) * F.cos(lon), f"_{side}y": F.cos(lat) * F.sin(lon), f"_{side}z": F.sin(lat)})

    home = placed(b, "b").withColumn(
        "_band", band(F.col("b_lat"))
    ).withColumn("_cell", cell(F.col("b_lon"), cells_around(F.col("_band"))))
    look = (
        placed(a, "a")
        .withColumn("_b0", band(F.col("a_lat")))
        .withColumn("_band", F.explode(F.sequence(F.col("_b0") - 1, F.col("_b0") + 1)))
        .withColumn("_n", cells_around(F.col("_band")))
        .withColumn("_c0", cell(F.col("a_lon"), F.col("_n")))
        .withColumn(
            "_cell",
            # Around the antimeridian the neighbours wrap; with few cells they may coincide.
            F.explode(F.array_distinct(F.array(*[F.pmod(F.col("_c0") + i, F.col("_n")) for i in (-1, 0, 1)]))),
        )
        .drop("_b0", "_c0", "_n")
    )
    pairs = balanced_join(look, home, ["_band", "_cell"], ["a_id"], rows_per_task)
    apart = [F.col(f"_a{c}") - F.col(f"_b{c}") for c in "xyz"]
    widest = 2 * math.sin(min(math.pi / 2, max(radius_m, 0.0) * 1.01 / 2 / 6_371_000.0))
    pairs = pairs.where(apart[0] * apart[0] + apart[1] * apart[1] + apart[2] * apart[2] <= widest * widest + 1e-28)
    d = METRIC[metric](F.col("a_lon"), F.col("a_lat"), F.col("b_lon"), F.col("b_lat"))
    return pairs.select("a_id", "b_id", d.alias("distance_m")).where(F.col("distance_m") <= radius_m)


# --- intersection -----------------------------------------------------------------------


#: Cells are halved while rows lie in so few of them and meet so many others there.
MOST_CELLS, LEAST_CROWD, HALVINGS = 12, 4, 4


def _halvings(a: DataFrame, b: DataFrame, cell: float) -> int:
    """How often to halve `cell`: the boxes of both sides still lie in few cells on average, and cells are not near empty."""
    size = [F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")]
    covered = [F.avg((1 + size[0] * (2**s / cell)) * (1 + size[1] * (2**s / cell))).alias(f"c{s}") for s in range(HALVINGS + 1)]
    mean = [df.select(*_RECT).agg(*covered).first() for df in (a, b)]
    few = [s for s in range(HALVINGS + 1) if all((m[f"c{s}"] or 0.0) <= MOST_CELLS for m in mean)]
    at = [F.floor(F.col(c) / cell).alias(f"_{c}") for c in ("minx", "miny")]
    n = F.col("count").cast("double")
    crowd = b.where("minx IS NOT NULL AND miny IS NOT NULL").groupBy(*at).count().agg(F.sum(n * n) / F.sum(n)).first()[0] or 0.0
    return max([s for s in few if crowd >= LEAST_CROWD * 4**s], default=0)


def join_spatial_intersects(
    a: DataFrame, b: DataFrame, cell: float = 0.05, refine: Column | None = None, rows_per_task: int = 1_000_000
) -> DataFrame:
    """(a_id, b_id) of intersecting rectangles, or of the geometries they bound.

    Both sides are listed under every grid cell they cover; a pair is reported only in the cell of
    its lower-left common corner, so no duplicate removal is needed. `refine` is an optional exact
    predicate over columns `a_geom` and `b_geom`, applied after the box test. Where cells are crowded and boxes
    small in them, the grid is made finer (`_halvings`, two small jobs), so fewer pairs meet that do not intersect.
    """
    if not (a.isStreaming or b.isStreaming):
        cell = cell / 2 ** _halvings(a, b, cell)

    def cover(df: DataFrame, side: str) -> DataFrame:
        keep = [F.col("id").alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in _RECT]]
        if "geom" in df.columns:
            keep.append(F.col("geom").alias(f"{side}_geom"))
        at = lambda c: F.floor(F.col(f"{side}_{c}") / cell).cast("long")
        return (
            df.select(*keep)
            .withColumn("_cx", F.explode(F.sequence(at("minx"), at("maxx"))))
            .withColumn("_cy", F.explode(F.sequence(at("miny"), at("maxy"))))
        )

    left, right = cover(a, "a"), cover(b, "b")
    pairs = balanced_join(left, right, ["_cx", "_cy"], ["a_id"], rows_per_task)
    box = geo.rect_intersects(
        tuple(F.col(f"a_{c}") for c in _RECT), tuple(F.col(f"b_{c}") for c in _RECT)
    )
    owner = (F.col("_cx") == F.floor(F.greatest("a_minx", "b_minx") / cell)) & (
        F.col("_cy") == F.floor(F.greatest("a_miny", "b_miny") / cell)
    )
    hit = pairs.where(box & owner)
    if refine is not None:
        hit = hit.where(refine)
    return hit.select("a_id", "b_id")


def spatial_clip_to_boundary(df: DataFrame, boundary: DataFrame, key: str = "id", cell: float = 0.05) -> DataFrame:
    """Rows whose rectangle meets any part of a boundary.

    The boundary stays a list of parts: "meets any part" needs no dissolved union.
    """
    left = df if key == "id" else df.withColumnRenamed(key, "id")
    parts = boundary.withColumn("id", F.monotonically_increasing_id()) if "id" not in boundary.columns else boundary
    inside = join_spatial_intersects(left, parts, cell).select(F.col("a_id").alias(key))
    return df.join(inside, key, "left_semi")


def st_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")
    )


# --- nearest neighbour ------------------------------------------------------------------

_FAN = 4  # children per axis and level
_DEEPEST = 12  # levels at most: 16.7 million cells per axis
_BOX = ("minx", "miny", "maxx", "maxy")


def _gap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(F.lit(0.0), lo1 - hi2, lo2 - hi1)


def _reach(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(hi1 - lo2, hi2 - lo1)


def _near_far(p: Column, g: Column) -> tuple[Column, Column]:
    """Least and greatest planar distance between places of two boxes."""
    near = F.hypot(_gap(p["minx"], p["maxx"], g["minx"], g["maxx"]), _gap(p["miny"], p["maxy"], g["miny"], g["maxy"]))
    return near, F.hypot(_reach(p["minx"], p["maxx"], g["minx"], g["maxx"]), _reach(p["miny"], p["maxy"], g["miny"], g["maxy"]))


def _within(near: Column, bound: Column) -> Column:
    # The factor absorbs rounding; an extra candidate costs little, a lost one would be wrong.
    return near <= bound * (1 + 1e-9) + 1e-12


class _Quadtree:
    """Cells of both sides (p points, g geometries), split by how many rows they hold.

    Level 0 is the finest; a cell has 4 x 4 children. A cell with at most `leaf_rows` rows of its side
    is a leaf wherever it stands, so every branch has its own depth. The root covers all rows, whatever
    their unit. Rows are folded to finest cells once; these and the tree's live cells are written, so the
    planner knows their sizes and a lost executor does not repeat them.
    """

    def __init__(self, spots: DataFrame, leaf_rows: int):
        spark = spots.sparkSession
        edge = spots.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy"), F.count(F.lit(1))).first()
        self.x0, self.y0 = edge[0] or 0.0, edge[1] or 0.0
        self.side = max((edge[2] or 0.0) - self.x0, (edge[3] or 0.0) - self.y0) or 1.0
        boxes = [f(c).alias(c) for f, c in zip((F.min, F.min, F.max, F.max), _BOX)]
        self.path, self.depth = scratch_path(spark, "quadtree"), _DEEPEST
        folded = spots.groupBy("side", *self.finest((F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2)).agg(F.count(F.lit(1)).alias("n"), *boxes)
        folded.write.partitionBy("side").parquet(f"{self.path}/cells")
        deepest = spark.read.schema("cx long, cy long, n long, minx double, miny double, maxx double, maxy double, side string").parquet(f"{self.path}/cells")

        def folded_to(depth: int) -> DataFrame:
            return deepest.groupBy("side", *[F.shiftright(c, 2 * (_DEEPEST - depth)).alias(c) for c in ("cx", "cy")]).agg(F.sum("n").alias("n"), *boxes)

        # Even rows need log16(rows / leaf) levels; denser places as many more as it takes to split them.
        self.depth = min(_DEEPEST, 1 + math.ceil(math.log(max(edge[4], 1) / leaf_rows + 1, _FAN * _FAN)))
        apart = (F.col("minx") < F.col("maxx")) | (F.col("miny") < F.col("maxy"))
        while self.depth < _DEEPEST and (folded_to(self.depth).agg(F.max(F.when(apart, F.col("n")))).first()[0] or 0) > leaf_rows:
            self.depth = min(_DEEPEST, self.depth + 3)
        cells = folded_to(self.depth)
        at = lambda c, level: F.shiftright(c, 2 * level)  # noqa: E731  (2 bits a level)
        spread = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(self.depth))))
        spread = spread.withColumns({c: F.expr(f"shiftright({c}, 2 * level)") for c in ("cx", "cy")})
        tree = spread.groupBy("side", "level", "cx", "cy").agg(F.sum("n").alias("n"), *[f(c).alias(c) for f, c in zip((F.min, F.min, F.max, F.max), _BOX)])
        node = F.struct("level", "cx", "cy")
        up = F.struct((F.col("level") + 1).alias("level"), at("cx", 1).alias("cx"), at("cy", 1).alias("cy"))
        tree = tree.select("side", "level", "n", node.alias("node"), up.alias("parent"), F.struct(*_BOX).alias("box"))
        kind = "struct<level: int, cx: bigint, cy: bigint>"
        one_place = (F.col("box.minx") == F.col("box.maxx")) & (F.col("box.miny") == F.col("box.maxy"))
        tree = tree.withColumn("leaf", (F.col("n") <= leaf_rows) | (F.col("level") == 0) | one_place)
        inner = tree.where(~F.col("leaf")).select("side", F.col("node").alias("parent"))
        live = tree.where(F.col("level") < self.depth).join(inner, ["side", "parent"], "left_semi").select("side", "level", "node", "parent", "box", "leaf")
        top = tree.where(F.col("level") == self.depth).select("side", "level", "node", "parent", "box", "leaf")
        live.unionByName(top).write.partitionBy("side").parquet(f"{self.path}/live")
        self.live = spark.read.schema(f"level int, node {kind}, parent {kind}, box struct<minx: double, miny: double, maxx: double, maxy: double>, leaf boolean, side string").parquet(f"{self.path}/live")
        self.cells = cells

    def finest(self, x: Column, y: Column) -> list[Column]:
        """Numbers of the finest cell of a place."""
        n = _FAN**_DEEPEST
        cell = lambda v, start: F.least(F.greatest(F.floor((v - start) / self.side * n), F.lit(0)), F.lit(n - 1)).cast("long")
        return [F.shiftright(c, 2 * (_DEEPEST - self.depth)).alias(name) for name, c in (("cx", cell(x, self.x0)), ("cy", cell(y, self.y0)))]

    def leaf_of(self, side: str) -> DataFrame:
        """(cx, cy, node): the leaf that covers each finest cell."""
        spread = self.cells.where(F.col("side") == side).select("cx", "cy", F.explode(F.sequence(F.lit(0), F.lit(self.depth))).alias("level"))
        node = F.struct("level", F.expr("shiftright(cx, 2 * level)").alias("cx"), F.expr("shiftright(cy, 2 * level)").alias("cy"))
        leaves = self.live.where((F.col("side") == side) & F.col("leaf")).select("node")
        return spread.select("cx", "cy", node.alias("node")).join(leaves, "node")

    def _steps(self, side: str, level: int) -> DataFrame:
        """(from, node, box): the children of inner cells of `level`, and leaves of it or above as their own."""
        own = self.live.where(F.col("side") == side)
        down = own.where(F.col("level") == level - 1).select(F.col("parent").alias(f"{side}_from"), F.col("node").alias(f"{side}_node"), F.col("box").alias(f"{side}_box"))
        stay = own.where((F.col("level") >= level) & F.col("leaf")).select(F.col("node").alias(f"{side}_from"), F.col("node").alias(f"{side}_node"), F.col("box").alias(f"{side}_box"))
        return down.unionByName(stay)

    def _prune(self, pairs: DataFrame) -> DataFrame:
        """Keeps pairs of cells that can hold the nearest geometry of some point."""
        near, far = _near_far(F.col("p_box"), F.col("g_box"))
        scored = pairs.withColumn("_near", near).withColumn("_far", far)
        if "_limit" in pairs.columns:  # what bounds the cell bounds its children
            scored = scored.where(_within(F.col("_near"), F.col("_limit")))
        # A cell's candidates are bounded by geometry, not by row counts, so this window stays small.
        bound = F.min("_far").over(W.partitionBy("p_node"))
        return scored.withColumn("_bound", bound).where(_within(F.col("_near"), F.col("_bound"))).select("p_node", "g_node", "g_box", "_bound")

    def pairs(self) -> DataFrame:
        """(p_node, cells): for each leaf of points, the leaves of geometries that may hold a nearest one, with their boxes."""
        top = lambda side: self.live.where((F.col("side") == side) & (F.col("level") == self.depth)).select(F.col("node").alias(f"{side}_node"), F.col("box").alias(f"{side}_box"))
        found = self._prune(top("p").withColumn("_one", F.lit(1)).join(top("g").withColumn("_one", F.lit(1)), "_one"))  # one root each
        for level in range(self.depth, 0, -1):
            parents = found.select(F.col("p_node").alias("p_from"), F.col("g_node").alias("g_from"), F.col("_bound").alias("_limit"))
            found = self._prune(parents.join(self._steps("p", level), "p_from").join(self._steps("g", level), "g_from"))
            if (self.depth - level) % 3 == 2 and level > 1:  # short plans; a lost executor repeats three levels at most
                spark, kept = found.sparkSession, f"{self.path}/pairs{level}"
                found.write.parquet(kept)
                found = spark.read.schema(found.schema).parquet(kept)
        return found.groupBy("p_node").agg(F.collect_list(F.struct("g_node", "g_box")).alias("cells"))


def join_knn1(
    points: DataFrame,
    geoms: DataFrame,
    cell: float = 0.02,
    metric: str = "spheroid",
    shape: str = "rect",
    with_closest: bool = False,
    leaf_rows: int = 24,
) -> DataFrame:
    """(id, nearest_id, distance_m): the planar nearest geometry of every point, reported in metres.

    Exact for any distribution and any unit of coordinates. Points and geometries stand in quadtrees whose
    cells are split by row counts, each branch to its own depth. From the roots, pairs of a point
    cell and a geometry cell are refined level by level, dropping geometry cells that are farther
    than another cell's farthest corner. Each point then drops cells once more by its own place
    before it meets their geometries, about `leaf_rows` a cell. Identical geometries are merged first; ties
    go to the smallest id. Lines cross many cells however small, so `nearest_lines` tiles the points instead.

    `shape` is rect (filled rectangle), segment or point.
    """
    if shape == "point":
        coords, box = ["lon", "lat"], [F.col(c) for c in ("lon", "lat", "lon", "lat")]
    elif shape == "segment":
        coords, box = ["x1", "y1", "x2", "y2"], []
    else:
        coords, box = list(_RECT), [F.col(c) for c in _RECT]

    whole = geoms.where(F.forall(F.array(*[F.col(c) for c in coords]), lambda c: c.isNotNull()))
    shapes_ = whole.groupBy(*[F.col(c).alias(f"g{i}") for i, c in enumerate(coords)]).agg(F.min("id").alias("nearest_id"))
    renamed = shapes_.select("nearest_id", *[F.col(f"g{i}").alias(c) for i, c in enumerate(coords)])
    if shape == "segment":
        located = points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("id", "lon", "lat").distinct()
        best = located.join(nearest_lines(located, renamed).withColumnRenamed("best", "_best"), ["lon", "lat"])
        return _nearest_columns(best, metric, with_closest)
    boxed = renamed.select("nearest_id", *[F.col(c).alias(f"g_{c}") for c in coords], *[b.alias(c) for c, b in zip([f"_{c}" for c in _BOX], box)])
    located = points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("id", "lon", "lat")
    spots = located.select(F.lit("p").alias("side"), *[F.col(c).alias(n) for n, c in zip(_BOX, ("lon", "lat", "lon", "lat"))])
    members = boxed.select(F.lit("g").alias("side"), *[F.col(f"_{c}").alias(c) for c in _BOX])
    tree = _Quadtree(spots.unionByName(members), leaf_rows)

    mine = located.select("*", *tree.finest(F.col("lon"), F.col("lat"))).join(tree.leaf_of("p").withColumnRenamed("node", "p_node"), ["cx", "cy"])
    here = F.struct(*[F.col(c).alias(n) for n, c in zip(_BOX, ("lon", "lat", "lon", "lat"))])
    scored = F.transform("cells", lambda c: F.struct(c["g_node"].alias("node"), _near_far(here, c["g_box"])[0].alias("near"), _near_far(here, c["g_box"])[1].alias("far")))
    tried = mine.join(tree.pairs(), "p_node").select("id", "lon", "lat", scored.alias("scored"))
    tried = tried.withColumn("_bound", F.array_min(F.transform("scored", lambda c: c["far"])))
    tried = tried.select("id", "lon", "lat", F.explode(F.filter("scored", lambda c: _within(c["near"], F.col("_bound")))).alias("c")).select("id", "lon", "lat", F.col("c.node").alias("g_node"))
    centre = tree.finest((F.col("_minx") + F.col("_maxx")) / 2, (F.col("_miny") + F.col("_maxy")) / 2)
    kept = boxed.select("nearest_id", *[f"g_{c}" for c in coords], *centre).join(tree.leaf_of("g").withColumnRenamed("node", "g_node"), ["cx", "cy"]).drop("cx", "cy")
    tried = tried.join(kept, "g_node")
    x, y = F.col("lon"), F.col("lat")
    g = [F.col(f"g_{c}") for c in coords]
    if shape == "rect":
        closest = geo.closest_on_rect(x, y, *g)
    else:
        closest = geo.st_point(*g)
    planar = geo.planar_distance(x, y, F.col("_c.x"), F.col("_c.y"))
    # Partial aggregation keeps one candidate per point and task before the shuffle.
    best = (
        tried.withColumn("_c", closest)
        .groupBy("id", "lon", "lat")
        .agg(F.min(F.struct(planar.alias("d"), F.col("nearest_id"), F.col("_c.x").alias("x"), F.col("_c.y").alias("y"))).alias("_best"))
    )
    return _nearest_columns(best, metric, with_closest)


def _nearest_columns(best: DataFrame, metric: str, with_closest: bool) -> DataFrame:
    out = [
        "id",
        F.col("_best.nearest_id").alias("nearest_id"),
        METRIC[metric](F.col("lon"), F.col("lat"), F.col("_best.x"), F.col("_best.y")).alias("distance_m"),
    ]
    if with_closest:
        out += [F.col("_best.x").alias("snapped_lon"), F.col("_best.y").alias("snapped_lat")]
    return best.select(*out)


def snap_to_nearest_building(
    points: DataFrame, buildings: DataFrame, cell: float = 0.02, metric: str = "spheroid"
) -> DataFrame:
    """(id, building_id, snapped_lon, snapped_lat, distance_m) for every point with a location."""
    geoms = buildings.withColumnRenamed("building_id", "id")
    return join_knn1(points, geoms, cell, metric, with_closest=True).withColumnRenamed("nearest_id", "building_id")


def snap_node_to_building(nodes: DataFrame, node_ids: DataFrame, buildings: DataFrame, cell: float = 0.02) -> DataFrame:
    """The same for chosen graph nodes."""
    chosen = nodes.join(node_ids, "node_id", "left_semi").select(F.col("node_id").alias("id"), "lon", "lat")
    return snap_to_nearest_building(chosen, buildings, cell).withColumnRenamed("id", "node_id")


# --- feature ingestion ------------------------------------------------------------------


def scan_geo_vector(df: DataFrame, id_col: str = "osm_id", min_area: float = 0.0) -> DataFrame:
    """(source_object, props, geom) from rows with a `geom` geometry column of any kind.

    Rows without geometry or id are skipped, and with a `min_area` those below so many square degrees, all parts
    less their holes; points and lines have no area.
    """
    rows = df.where(F.col("geom").isNotNull() & F.col(id_col).isNotNull())
    if min_area > 0:
        rows = rows.where(shapes.st_area_planar(F.col("geom")) >= min_area)
    rest = [F.col(c) for c in df.columns if c != "geom"]
    return rows.select(F.col(id_col).cast("string").alias("source_object"), F.to_json(F.struct(*rest)).alias("props"), "geom")


def load_plot_geometry(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """(plot_id, geom, centroid) from cadastral payloads: outline from WKT, centre from the point."""
    p = F.from_json(F.col(payload), "struct<id:string,wkt:string,point:struct<lon:double,lat:double>>")
    return raw.select(p.alias("_p")).select(
        F.col("_p.id").alias("plot_id"),
        shapes.st_geom_from_text(F.col("_p.wkt")).alias("geom"),
        geo.st_point(F.col("_p.point.lon"), F.col("_p.point.lat")).alias("centroid"),
    )


def tile_layer_view(df: DataFrame, key: str) -> DataFrame:
    """(id, web-mercator box) of rectangles for a tile layer."""
    return df.select(
        F.col(key).alias("id"),
        geo.mercator_x(F.col("minx")).alias("minx_3857"), geo.mercator_y(F.col("miny")).alias("miny_3857"),
        geo.mercator_x(F.col("maxx")).alias("maxx_3857"), geo.mercator_y(F.col("maxy")).alias("maxy_3857"),
    )


def tile_assign(points: DataFrame, zmin: int, zmax: int) -> DataFrame:
    """(z, x, y, n): points per tile and zoom level.

    Points are counted on the finest level only; coarser tiles are folded from it by halving.
    """
    finest = points.groupBy(
        geo.tile_x(F.col("lon"), F.lit(zmax)).alias("fx"), geo.tile_y(F.col("lat"), F.lit(zmax)).alias("fy")
    ).agg(F.count(F.lit(1)).alias("c"))
    spread = finest.withColumn("z", F.explode(F.sequence(F.lit(zmin), F.lit(zmax))))
    scale = F.pow(F.lit(2.0), F.lit(zmax) - F.col("z"))
    return spread.groupBy(
        "z", F.floor(F.col("fx") / scale).alias("x"), F.floor(F.col("fy") / scale).alias("y")
    ).agg(F.sum("c").alias("n"))
