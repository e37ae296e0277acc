"""Clipping by boundary polygons and areas of unions.

Geometries are those of `functions.shapes`. Nothing compares a feature with a whole boundary: borders meet in
grid cells, insides are told by the edges of one polygon in one strip of latitude, and unions are
measured cell by cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrawatt.functions import geo, shapes
from terrawatt.operators.skew import balanced_join
from terrawatt.session import scratch_path

#: Cells are widened by this share of their side, as ends of cut pieces are rounded.
_SLACK = 1e-6
#: Covers double their cells up to this level, 2^24 sides of a base cell.
_TOP = 24
_ENDS = ("x1", "y1", "x2", "y2")


# --- clip -------------------------------------------------------------------------------


def _segments(rings: Column, closed: Column) -> Column:
    """Segments of rings or lines; a single vertex is a segment of no length, an open outline is closed."""

    def of(ring: Column) -> Column:
        first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
        whole = F.when((F.size(ring) == 1) | (closed & (first != last)), F.concat(ring, F.array(first))).otherwise(ring)
        return geo._let(whole, geo._segments)

    filled = F.filter(rings, lambda r: F.size(r) > 0)
    return F.transform(F.flatten(F.transform(filled, of)), lambda s: F.struct(*[s[p][c].alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for c in "xy"]))


def _in_cells(segments: DataFrame, cell: float) -> DataFrame:
    """Segments under every cell (cx, cy) that they may touch: cut into pieces of at most a cell per axis."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    many = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / cell)).cast("int")
    cut = segments.withColumn("_n", many).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    for c, d in (("x", dx), ("y", dy)):
        ends = [F.col(f"{c}1") + d * (F.col("_i") + k) / F.col("_n") for k in (0, 1)]
        low, high = F.floor(F.least(*ends) / cell - _SLACK), F.floor(F.greatest(*ends) / cell + _SLACK)
        cut = cut.withColumn(f"c{c}", F.explode(F.sequence(low, high)))
    return cut.drop("_n", "_i")


def _boxed(df: DataFrame, cell: float) -> DataFrame:
    """Rows with minx..maxy under the at most four cells (level, cx, cy) of the level that their longer side asks for."""
    side = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    level = F.when(side <= cell, 0).otherwise(F.least(F.lit(_TOP), F.ceil(F.log2(side / cell)))).cast("int")
    rows = df.withColumn("level", level)
    for c in "xy":
        at = lambda end: F.floor(F.col(f"{end}{c}") / (cell * F.pow(F.lit(2.0), F.col("level"))))
        rows = rows.withColumn(f"c{c}", F.explode(F.sequence(at("min"), at("max"))))
    return rows


def _probes(points: DataFrame, levels: DataFrame, cell: float) -> DataFrame:
    """Points (x, y) under their cell of each level from the least to the highest one of the boxes."""
    low, high = (F.coalesce(levels.select(f("level")).scalar(), F.lit(0)) for f in (F.min, F.max))
    rows = points.withColumn("level", F.explode(F.sequence(low, high)))
    return rows.withColumns({f"c{c}": F.floor(F.col(c) / (cell * F.pow(F.lit(2.0), F.col("level")))) for c in "xy"})


def _held() -> Column:
    return F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy"))


def _corner(rings: Column) -> Column:
    return F.get(F.get(rings, F.lit(0)), F.lit(0))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boundary_parts(boundary: DataFrame, geom: str = "geom") -> DataFrame:
    """(pid, rings): the different polygons of a boundary, named by their content; other kinds are left out."""
    own = boundary.where(F.col(geom)["type"].isin(*shapes.POLYGONS)).select(F.explode(F.col(geom)["parts"]).alias("rings"))
    filled = own.where(F.size(F.flatten("rings")) > 0)
    return filled.groupBy(F.sha2(F.to_json("rings"), 256).alias("pid")).agg(F.any_value("rings").alias("rings"))


def features_in_boundary(
    features: DataFrame, boundary: DataFrame, key: str = "id", geom: str = "geom", cell: float = 0.01, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Distinct keys of the features that share at least a point with a polygon of the boundary.

    Polygons are closed sets: their borders count, those of holes too, what lies inside a hole does not.
    Features may be points, lines, polygons with holes and MULTI forms of these. A feature meets a polygon
    if a segment of it touches an edge (both are listed by cells of side `cell`), if a vertex of one of its
    parts lies inside (the even-odd rule over the polygon's edges in the vertex's strip of latitude), or if a
    vertex of the polygon lies inside the feature. Polygons may overlap; equal ones count once.
    Rows with a null key, no geometry or an EMPTY one are left out. Cells, and strips of one polygon, with more than
    `rows_per_task` features are split. The boundary's polygons and the features within its box are written to the
    shared folder once, since every step reads them.
    """
    path = scratch_path(features.sparkSession, "clip")
    ring_box = shapes.st_envelope(shapes.geometry("POLYGON", F.array("rings")))
    parts = _stored(boundary_parts(boundary, geom).withColumn("box", ring_box), f"{path}/parts")
    kind = F.col(geom)["type"]
    whole = features.where(F.col(key).isNotNull() & kind.isNotNull()).select(F.col(key).alias("key"), F.col(geom).alias("geom"))
    edges = parts.select("pid", F.explode(_segments(F.col("rings"), F.lit(True))).alias("e")).select("pid", "e.*")
    boxes = parts.select("pid", "box.*")
    extent = {c: boxes.select(f(c)).scalar() for c, f in (("minx", F.min), ("miny", F.min), ("maxx", F.max), ("maxy", F.max))}
    placed = whole.withColumn("box", shapes.st_envelope(F.col("geom")))
    near = placed.where(
        (F.col("box.minx") <= extent["maxx"]) & (F.col("box.maxx") >= extent["minx"]) & (F.col("box.miny") <= extent["maxy"]) & (F.col("box.maxy") >= extent["miny"])
    )
    near = _stored(near, f"{path}/near")

    # 1. Borders.
    is_area = F.col("geom.type").isin(*shapes.POLYGONS)
    own = near.select("key", F.explode(_segments(F.flatten("geom.parts"), is_area)).alias("s")).select("key", "s.*")
    theirs = _in_cells(edges.select(*_ENDS), cell).select("cx", "cy", F.struct(*_ENDS).alias("edge"))
    met = balanced_join(_in_cells(own, cell), theirs, ["cx", "cy"], ["key", *_ENDS], rows_per_task)
    ends = lambda v, n: geo.st_point(v(f"x{n}"), v(f"y{n}"))
    pair = lambda v: {"a": ends(v, 1), "b": ends(v, 2)}
    touching = met.where(geo._segments_touch(pair(F.col), pair(lambda c: F.col("edge")[c]))).select("key")

    # 2. Parts inside a polygon: one vertex tells, as no border is met otherwise.
    corners = near.select("key", F.explode(F.transform("geom.parts", _corner)).alias("p")).select("key", "p.x", "p.y").where("x IS NOT NULL")
    covers = _boxed(boxes, cell)
    asked = balanced_join(_probes(corners, covers, cell), covers, ["level", "cx", "cy"], ["key", "x", "y"], rows_per_task)
    asked = asked.where(_held()).select("key", "x", "y", "pid", F.floor(F.col("y") / cell).alias("strip"))
    rows = edges.where("y1 <> y2").withColumn("strip", F.explode(F.sequence(F.floor(F.least("y1", "y2") / cell), F.floor(F.greatest("y1", "y2") / cell))))
    rays = balanced_join(asked, rows, ["pid", "strip"], ["key", "x", "y"], rows_per_task)
    at = F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossed = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < at)
    inside = rays.groupBy("key", "x", "y", "pid").agg(F.count_if(crossed).alias("n")).where("n % 2 = 1").select("key")

    # 3. Polygons inside a feature.
    spots = parts.select(_corner(F.col("rings")).alias("p")).select("p.x", "p.y")
    large = _boxed(near.where(is_area).select("key", "box.*"), cell)
    holding = balanced_join(large, _probes(spots, large, cell), ["level", "cx", "cy"], ["key"], rows_per_task)
    holding = holding.where(_held()).select("key", "x", "y").join(near.select("key", "geom"), "key")
    around = holding.where(shapes.st_contains_point(F.col("geom"), F.col("x"), F.col("y"))).select("key")
    return touching.union(inside).union(around).distinct().select(F.col("key").alias(key))


def clip_to_boundary(features: DataFrame, boundary: DataFrame, key: str = "id", geom: str = "geom", cell: float = 0.01) -> DataFrame:
    """The features that `features_in_boundary` finds, with all their columns."""
    return features.join(features_in_boundary(features, boundary, key, geom, cell), key, "left_semi")


# --- union ------------------------------------------------------------------------------


def _clipped(boxes: DataFrame, side: float, group: Sequence[str]) -> DataFrame:
    """Different pieces (cx, cy, x1..y2) of boxes in the cells of a power of two; ends of cells are exact doubles."""
    rows = boxes
    for c in "xy":
        last = F.ceil(F.col(f"{c}2") / side) - 1
        rows = rows.withColumn(f"c{c}", F.explode(F.sequence(F.floor(F.col(f"{c}1") / side), last)))
        cut = {f"{c}1": F.greatest(F.col(f"{c}1"), F.col(f"c{c}") * F.lit(side)), f"{c}2": F.least(F.col(f"{c}2"), (F.col(f"c{c}") + 1) * F.lit(side))}
        rows = rows.withColumns(cut)
    return rows.select(*group, "cx", "cy", *_ENDS).distinct()


def union_area(boxes: DataFrame, by: Sequence[str] = (), geographic: bool = False, side: float = 0.25, per_cell: int = 32, depth: int = 16) -> DataFrame:
    """(*by, area): the area that the boxes minx..maxy of each group cover together, overlaps once.

    In square degrees, or in square metres on the spheroid. Boxes are cut by cells of `side` degrees (a power of
    two). A cell that one box fills is known. A cell with more than `per_cell` different pieces is cut into
    four, at most `depth` times; the others are swept: strips between neighbouring x, and in each strip the gain
    of every piece over the highest end before it. Exact whatever the depth, which only bounds the work of a
    cell. Every level is written to the shared folder. Boxes with null ends, or without area, add nothing; a group of such boxes has
    area 0, and no rows at all give no row if `by` is set, else one row of area 0.
    """
    path, group = scratch_path(boxes.sparkSession, "union"), list(by)
    named = {"minx": "x1", "miny": "y1", "maxx": "x2", "maxy": "y2"}
    solid = boxes.where("minx < maxx AND miny < maxy").select(*group, *[F.col(a).cast("double").alias(b) for a, b in named.items()])
    cell_key = [*group, "cx", "cy"]
    todo, found = solid, None
    for level in range(depth + 1):
        step = side / 2**level
        pieces = _clipped(todo, step, group)
        x0, y0 = F.col("cx") * F.lit(step), F.col("cy") * F.lit(step)
        full = (F.col("x1") == x0) & (F.col("y1") == y0) & (F.col("x2") == x0 + step) & (F.col("y2") == y0 + step)
        sizes = pieces.groupBy(*cell_key).agg(F.count(F.lit(1)).alias("n"), F.max(full).alias("full"))
        more = F.lit(False) if level == depth else F.col("n") > per_cell
        told = _null_safe(pieces, sizes, cell_key).where(~F.col("full") | full)
        stored = _stored(told.select(*cell_key, *_ENDS, (more & ~F.col("full")).alias("more")), f"{path}/level{level}")
        done = stored.where("NOT more").withColumn("level", F.lit(level)).drop("more")
        found = done if found is None else found.unionByName(done)
        todo = stored.where("more").select(*group, *_ENDS)
        if todo.isEmpty():
            break

    if geographic:
        found = found.withColumns({"x1": F.radians("x1"), "x2": F.radians("x2"), "y1": geo.authalic_y(F.col("y1")), "y2": geo.authalic_y(F.col("y2"))})
    where = [*group, "level", "cx", "cy"]
    ends = found.select(*where, F.explode(F.array("x1", "x2")).alias("lo")).distinct()
    strips = ends.withColumn("hi", F.lead("lo").over(W.partitionBy(*where).orderBy("lo"))).where("hi IS NOT NULL")
    swept = _null_safe(found, strips, where).where("x1 <= lo AND hi <= x2")
    before = F.max("y2").over(W.partitionBy(*where, "lo").orderBy("y1", "y2").rowsBetween(W.unboundedPreceding, -1))
    gain = F.greatest(F.lit(0.0), F.col("y2") - F.greatest(F.col("y1"), F.coalesce(before, F.col("y1"))))
    areas = swept.select(*group, ((F.col("hi") - F.col("lo")) * gain).alias("area"))
    if not group:
        return areas.agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("area"))
    every = boxes.select(*group, F.lit(0.0).alias("area")).distinct()
    return areas.unionByName(every).groupBy(*group).agg(F.sum("area").alias("area"))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    l, r = left.alias("l"), right.alias("r")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    return l.join(r, on).select("l.*", *[F.col(f"r.`{c}`") for c in right.columns if c not in keys])
