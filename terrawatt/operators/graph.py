"""Road graph, spatial cache, scores, feature store and vertex metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions import geo
from terrawatt.functions.scalar import epoch_millis, natural_id
from terrawatt.operators import reach
from terrawatt.operators.changes import merge_upsert
from terrawatt.operators.crowding import others_within
from terrawatt.operators.joins import join_geometry_equality
from terrawatt.operators.setops import union_all_edges_reverse
from terrawatt.operators.spatial import METRIC, join_knn1
from terrawatt.session import Stored


VERTEX_SCHEMA = "id string, value double, v_type string, properties map<string,string>"
#: Sketches (up to 4 KB each) that one task merges in memory, the links into them, and such blocks of vertices in one pass.
BLOCK_SKETCHES, BLOCK_LINKS, PASS_BLOCKS = 49_152, 1 << 22, 24
EDGE_SCHEMA = "src string, dst string, weight double, e_type string, properties map<string,string>"


def graph_to_dataframes(spark: SparkSession, vertices: list[tuple], edges: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """Literal vertices and edges as frames; real graphs are read from tables."""
    return spark.createDataFrame(vertices, VERTEX_SCHEMA), spark.createDataFrame(edges, EDGE_SCHEMA)


def graph_views(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Projections for graph consumers; edge times as epoch milliseconds."""
    v = vertices.select(*[c for c in ("id", "value", "v_type", "properties", "created_at") if c in vertices.columns])
    zoned = isinstance(edges.schema["timestamp"].dataType, T.TimestampType)
    millis = epoch_millis(F.col("timestamp"), zoned)
    cols = [c for c in ("src", "dst", "weight", "e_type", "properties") if c in edges.columns]
    return v, edges.select(*cols, millis.alias("timestamp_ms"))


def graph_nodes_build(buildings: DataFrame, roads: DataFrame) -> DataFrame:
    """Centroids of building rectangles and all road vertices as nodes; shared vertices repeat.

    Roads are segments (x1, y1, x2, y2) or polylines in an array column `line`.
    """
    centroids = buildings.select(
        natural_id(F.lit("b"), F.col("building_id")).alias("node_id"),
        F.lit("building_centroid").alias("node_type"),
        F.col("building_id").alias("ref_id"),
        ((F.col("minx") + F.col("maxx")) / 2).alias("lon"),
        ((F.col("miny") + F.col("maxy")) / 2).alias("lat"),
    )
    line = F.col("line") if "line" in roads.columns else F.array(
        geo.st_point(F.col("x1"), F.col("y1")), geo.st_point(F.col("x2"), F.col("y2"))
    )
    vertices = roads.select("road_id", F.posexplode(line).alias("pos", "p")).select(
        natural_id(F.lit("r"), F.col("road_id"), F.col("pos")).alias("node_id"),
        F.lit("road_endpoint").alias("node_type"),
        F.col("road_id").alias("ref_id"),
        F.col("p.x").alias("lon"),
        F.col("p.y").alias("lat"),
    )
    return centroids.unionByName(vertices)


def graph_road_edges(roads: DataFrame, nodes: DataFrame, metric: str = "spheroid") -> DataFrame:
    """Road edges between the nodes at both ends, reversed as well for two-way roads."""
    length = METRIC[metric](F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    matched = join_geometry_equality(roads, nodes).select("road_id", "oneway", "from_node", "to_node", length.alias("weight"))
    directed = union_all_edges_reverse(matched, F.col("oneway") == "B")
    return directed.select(
        natural_id(F.col("road_id"), F.col("from_node"), F.col("to_node")).alias("edge_id"),
        "from_node", "to_node", "weight", F.lit("road").alias("edge_type"), F.col("road_id").alias("ref_id"),
    )


def node_spatial_cache(
    nodes: DataFrame, buildings: DataFrame, roads: DataFrame, cell: float = 0.02, metric: str = "spheroid"
) -> DataFrame:
    """Nearest building and nearest road of every located node, set-based."""
    points = nodes.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        F.col("node_id").alias("id"), "lon", "lat"
    )
    b = join_knn1(points, buildings.withColumnRenamed("building_id", "id"), cell, metric).select(
        F.col("id").alias("node_id"), F.col("nearest_id").alias("building_id"), F.col("distance_m").alias("distance_to_bldg")
    )
    r = join_knn1(points, roads.withColumnRenamed("road_id", "id"), cell, metric, shape="segment").select(
        F.col("id").alias("node_id"), F.col("nearest_id").alias("nearest_road_id"), F.col("distance_m").alias("distance_to_road")
    )
    return points.withColumnRenamed("id", "node_id").join(b, "node_id", "left").join(r, "node_id", "left")


def cache_coverage_check(cache: DataFrame) -> DataFrame:
    known = F.col("nearest_road_id").isNotNull()
    return cache.agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(known).alias("with_road"), F.count_if(~known).alias("without_road")
    )


def _centroids(nodes: DataFrame) -> DataFrame:
    """(node_id, building_id) of the nodes that stand for buildings; `ref_id` of the others names roads."""
    return nodes.where(F.col("node_type") == "building_centroid").select("node_id", F.col("ref_id").alias("building_id"))


def enrich_nodes(nodes: DataFrame, geoms: DataFrame, ids: DataFrame) -> DataFrame:
    """Geometry of the building behind each requested node."""
    wanted = _centroids(nodes).join(ids, "node_id", "left_semi")
    return wanted.join(geoms, "building_id").drop("building_id")


def _end_counts(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array_distinct(F.array("src", "dst"))).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def _degrees(vertices: DataFrame, counts: DataFrame) -> DataFrame:
    return vertices.select("id").join(counts, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def graph_degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of edges at each vertex; a self-loop counts once, an isolated vertex 0."""
    return _degrees(vertices, _end_counts(edges))


def graph_simple_score(vertices: DataFrame) -> DataFrame:
    return vertices.select("id", F.col("value").alias("score"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex id of each undirected component.

    Ids are hashed to longs, with a seed for which no two ids of the graph share one. In each round
    every vertex takes its smallest neighbour (or itself) as its parent and links are replaced by
    those between parents, which keeps components together and drops most links at once; the rounds' parents are
    then followed from the last to the first. What is small is drawn anew each round, so the vertices left fall
    by a constant factor in expectation, whatever the order of ids. Neighbour sets are never collected: the minimum
    is aggregated before the shuffle. Each round is stored, so lost executors re-run one round.
    """
    stored = Stored(vertices.sparkSession, "components")
    pairs = edges.where("src <> dst").select(F.array("src", "dst").alias("p"))
    ends = stored.write(pairs.select(F.explode("p").alias("id")).distinct(), "ends")
    n, seed = ends.count(), 42
    while ends.select(F.xxhash64("id", F.lit(seed))).distinct().count() < n:
        seed += 1
    key = lambda c: F.xxhash64(c, F.lit(seed))
    own = pairs.select(key(F.col("p")[0]).alias("a"), key(F.col("p")[1]).alias("b"))
    links = stored.write(own.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links0")
    parents, last = [], 0
    while not links.isEmpty():
        turn = F.xxhash64(F.lit(last)) if last else F.lit(0).cast("long")  # flips bits, so it is its own inverse
        both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = F.min(F.col("v").bitwiseXOR(turn))
        up = both.groupBy("u").agg(F.least(least, F.col("u").bitwiseXOR(turn)).bitwiseXOR(turn).alias("p"))
        up = stored.write(up, f"parents{last}")
        parents.append(up)
        met = links.join(up, "u").select(F.col("p").alias("a"), F.col("v").alias("u")).join(up, "u").select("a", F.col("p").alias("b")).where("a <> b")
        last += 1
        links = stored.write(met.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"links{last}")
        stored.drop(f"links{last - 1}")
    if not parents:
        return vertices.select("id", F.col("id").alias("component"))
    root = parents.pop()
    for i, up in reversed([*enumerate(parents)]):
        above = root.select(F.col("u").alias("p"), F.col("p").alias("q"))
        root = stored.write(up.join(above, "p", "left").select("u", F.coalesce("q", "p").alias("p")), f"roots{i}")
    placed = stored.write(ends.select("id", key("id").alias("u")).join(root, "u").select("id", "p"), "placed")
    names = placed.groupBy("p").agg(F.min("id").alias("component"))
    found = placed.join(names, "p").select("id", "component")
    return vertices.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _free_seed(ids: DataFrame) -> int:
    """A seed for which no two of the distinct `ids` share a hash."""
    n, seed = ids.count(), 42
    while ids.select(F.xxhash64("id", F.lit(seed))).distinct().count() < n:
        seed += 1
    return seed


def _reached(stored: Stored, vertices: DataFrame, edges: DataFrame, ends: DataFrame, k: int, lg_config: int) -> DataFrame:
    """(id, reached): estimated number of vertices within `k` hops, itself included, by distinct-count sketches.

    Vertices are hashed to longs without collisions and dealt into blocks, whose links are stored once, by their
    sources. In a hop a sketch is packed and travels once to each block in which it has neighbours; a task keeps the
    sketches of one block in memory and takes in what arrives. Blocks with far more links than others go to several tasks
    and the parts are united. `PASS_BLOCKS` are taken at a time, whose shuffle files go when the pass ends. The
    last hop stores estimates only; of sketches with registers they follow from the registers, in whatever order they met.
    """
    alike = vertices.select("id").union(edges.select("src")).union(edges.select("dst")).schema["id"].dataType
    own = vertices.select(F.col("id").cast(alike), F.lit(0).cast("long").alias("degree"), F.lit(True).alias("own"))
    known = own.union(ends.select(F.col("id").cast(alike), "degree", F.lit(False))).where("id IS NOT NULL")
    ids = stored.write(known.groupBy("id").agg(F.max("degree").alias("degree"), F.max("own").alias("own")), "ids")
    seed = _free_seed(ids)
    key = lambda c: F.xxhash64(F.col(c).cast(alike), F.lit(seed))
    sizes = ids.select(key("id").alias("key"), (F.col("degree") + 1).alias("links"))
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("links"), F.lit(0))).first()
    most = max(1, (BLOCK_SKETCHES << 12) >> max(12, lg_config))
    blocks = max(PASS_BLOCKS, math.ceil(n / most), math.ceil(total / BLOCK_LINKS))
    crowded = sizes.groupBy(F.pmod("key", F.lit(blocks)).alias("block")).agg(F.sum("links").alias("links")).where(F.col("links") > 2 * BLOCK_LINKS)
    pieces = reach.Pieces(blocks, {r.block: math.ceil(r.links / BLOCK_LINKS) for r in crowded.collect()})

    pairs = edges.where("src <> dst").select(key("src").alias("a"), key("dst").alias("b"))
    dealt = pairs.union(ids.select(key("id"), key("id"))).mapInArrow(reach.deal(pieces), "piece int, data binary")
    gathered = dealt.repartitionById(pieces.n, F.col("piece")).mapInArrow(reach.gather(pieces), reach.LINK_ROWS)
    rows = stored.write(gathered.withColumn("to", F.col("key").isNotNull()), "links", ("to",))
    links, targets = rows.where("NOT to").select("piece", "turn", "data"), rows.where("to").select("key", "targets")

    named = ids.where("own").select("id", key("id").alias("key"))
    sketches = named.groupBy("key").agg(F.hll_sketch_agg("id", lg_config).alias("s"))
    if not k:
        return stored.write(named.join(sketches, "key").select("id", F.hll_sketch_estimate("s").alias("reached")), "hop0")
    sketches = stored.write(sketches.join(targets, "key"), "hop0")
    step = math.ceil(pieces.n / math.ceil(pieces.n / PASS_BLOCKS))
    for hop in range(1, k + 1):
        for low in range(0, pieces.n, step):
            high = min(low + step, pieces.n)
            here = links.where(F.col("piece").between(low, high - 1))
            sent = sketches.select("key", "s", "targets").mapInArrow(reach.send(low, high, lg_config), reach.MESSAGES)
            met = here.union(sent).repartitionById(high - low, F.col("piece") - low).sortWithinPartitions("piece", "turn")
            found = met.mapInArrow(reach.meet(pieces, lg_config), reach.SKETCHES)
            if hop == k:
                estimate = F.when(F.col("whole"), F.hll_sketch_estimate("s"))
                found = found.select("key", "whole", F.when(~F.col("whole"), F.col("s")).alias("s"), estimate.alias("reached"))
            found = stored.write(found, f"met{hop}", spark__sql__execution__arrow__maxBytesPerBatch="16MB")
        stored.drop(f"hop{hop - 1}")
        parts = found.where("NOT whole").groupBy("key").agg(F.hll_union_agg("s").alias("s"))
        if hop < k:
            sketches = stored.write(found.where("whole").select("key", "s").union(parts).join(targets, "key"), f"hop{hop}")
        else:
            estimates = found.where("whole").select("key", "reached").union(parts.select("key", F.hll_sketch_estimate("s")))
            sketches = stored.write(named.join(estimates, "key").select("id", "reached"), f"hop{hop}")
        stored.drop(f"met{hop}")
    stored.drop("links", "ids")
    return sketches


def graph_metrics(vertices: DataFrame, edges: DataFrame, k: int | None = None, lg_config: int = 12) -> DataFrame:
    """(id, centrality, reachability_score) of the undirected graph.

    Centrality is the degree over n - 1. Reachability is the share of the other vertices that can
    be reached: exactly, over any number of hops, for `k=None`; within `k` hops by merging one
    bounded-size distinct-count sketch per vertex with its neighbours'. Exact k-hop sets would hold the
    product of a hub's neighbours.
    """
    n = vertices.agg(F.count(F.lit(1))).scalar()
    others = F.nullif(n - 1, F.lit(0).cast("bigint"))
    if k is None:
        degree = graph_degree(vertices, edges)
        members = connected_components(vertices, edges)
        sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        scores = members.join(sizes, "component").select("id", F.try_divide(F.col("size") - 1, others).alias("reachability_score"))
    else:
        stored = Stored(vertices.sparkSession, "k-hops")
        ends = stored.write(_end_counts(edges), "ends")
        degree = _degrees(vertices, ends)
        reached = _reached(stored, vertices, edges, ends, k, lg_config)
        scores = reached.select("id", F.try_divide(F.col("reached") - 1, others).alias("reachability_score"))
    return degree.select("id", F.try_divide(F.col("degree"), others).alias("centrality")).join(scores, "id")


# --- scores and features ----------------------------------------------------------------


def building_accessibility(buildings: DataFrame, nodes: DataFrame, cache: DataFrame, roads: DataFrame) -> DataFrame:
    n = _centroids(nodes)
    c = cache.select("node_id", "distance_to_road", "nearest_road_id")
    r = roads.select(F.col("road_id").alias("nearest_road_id"), "road_type", "maxspeed")
    return (
        buildings.select("building_id").join(n, "building_id").join(c, "node_id").join(r, "nearest_road_id", "left")
        .select("building_id", "distance_to_road", "nearest_road_id", "road_type", "maxspeed")
    )


def _closeness(distance: Column) -> Column:
    return 1 / (1 + distance)


def _building_nodes(nodes: DataFrame, cache: DataFrame) -> DataFrame:
    """Distance of each building's centroid node to its nearest road."""
    return _centroids(nodes).join(cache.select("node_id", "distance_to_road"), "node_id")


def risk_score(buildings: DataFrame, nodes: DataFrame, cache: DataFrame) -> DataFrame:
    d = _building_nodes(nodes, cache).select("building_id", _closeness(F.col("distance_to_road")).alias("risk_score"))
    return buildings.select("building_id").join(d, "building_id", "left")


def accessibility_score(buildings: DataFrame, nodes: DataFrame, cache: DataFrame) -> DataFrame:
    d = _building_nodes(nodes, cache).select(
        "building_id", _closeness(F.col("distance_to_road")).alias("accessibility_score")
    )
    return buildings.select("building_id").join(d, "building_id", "left")


def building_metrics_refresh(
    buildings: DataFrame, nodes: DataFrame, cache: DataFrame, as_of: str, metrics: DataFrame | None = None
) -> DataFrame:
    """Both scores of all buildings, merged over earlier metrics if given. One join serves both."""
    d = _building_nodes(nodes, cache).select("building_id", _closeness(F.col("distance_to_road")).alias("_s"))
    fresh = buildings.select("building_id").join(d, "building_id", "left").select(
        "building_id", F.col("_s").alias("risk_score"), F.col("_s").alias("accessibility_score"),
        F.lit(as_of).cast("timestamp_ntz").alias("updated_at"),
    )
    return fresh if metrics is None else merge_upsert(metrics, fresh, ["building_id"], [F.col("updated_at").desc()])


def feature_store_refresh(
    buildings: DataFrame, geoms: DataFrame, nodes: DataFrame, cache: DataFrame, as_of: str,
    density_radius_m: float = 500.0, store: DataFrame | None = None, metric: str = "spheroid",
) -> DataFrame:
    """Long features per building: distance to road, accessibility, buildings within the radius."""
    d = _building_nodes(nodes, cache)
    centres = geoms.select(
        F.col("building_id").alias("id"), ((F.col("minx") + F.col("maxx")) / 2).alias("lon"),
        ((F.col("miny") + F.col("maxy")) / 2).alias("lat"),
    )
    density = others_within(centres, density_radius_m, metric).select(F.col("id").alias("building_id"), F.col("n").alias("_density"))
    wide = buildings.select("building_id").join(d, "building_id", "left").join(density, "building_id", "left")
    entry = lambda name, value: F.struct(F.lit(name).alias("feature_name"), value.alias("feature_value"))
    long = wide.select(
        F.col("building_id").alias("entity_id"),
        F.lit("BUILDING").alias("entity_type"),
        F.inline(F.array(
            entry("distance_to_road", F.col("distance_to_road")),
            entry("accessibility", _closeness(F.col("distance_to_road"))),
            entry("building_density", F.coalesce("_density", F.lit(0)).cast("double")),
        )),
    ).withColumn("computed_at", F.lit(as_of).cast("timestamp_ntz"))
    if store is None:
        return long
    return merge_upsert(store, long, ["entity_id", "entity_type", "feature_name"], [F.col("computed_at").desc()])


# --- flattened read models --------------------------------------------------------------


def api_building(buildings: DataFrame, geoms: DataFrame, metrics: DataFrame) -> DataFrame:
    geom = [c for c in geoms.columns if c != "building_id"]
    return buildings.join(geoms, "building_id").join(metrics, "building_id", "left").select(
        "building_id", "name", *geom, "risk_score"
    )


def api_building_enriched(
    buildings: DataFrame, geoms: DataFrame, metrics: DataFrame, nodes: DataFrame, graph: DataFrame
) -> DataFrame:
    """Buildings with scores and graph metrics; `graph` is keyed by node_id."""
    geom = [c for c in geoms.columns if c != "building_id"]
    n = _centroids(nodes)
    own = [c for c in ("building_id", "name", "building_type", "status") if c in buildings.columns]
    return (
        buildings.join(geoms, "building_id").join(metrics, "building_id", "left")
        .join(n, "building_id", "left").join(graph, "node_id", "left")
        .select(*own, *geom, "risk_score", "accessibility_score", "centrality", "reachability_score")
    )
