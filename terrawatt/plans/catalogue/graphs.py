"""Road graph, formulas, scores."""

from pyspark.sql import functions as F

from terrawatt.functions.scalar import natural_id
from terrawatt.operators import formula as fm
from terrawatt.operators import graph as gr
from terrawatt.operators.joins import join_geometry_equality
from terrawatt.plans.catalogue.geospatial import spheroid
from terrawatt.plans.registry import query
from terrawatt.session import scratch_path

AS_OF = "2024-01-31 00:00:00"

NODES = """SELECT md5(concat('b|', CAST(building_id AS VARCHAR))) AS node_id, 'building_centroid' AS node_type, building_id AS ref_id,
    (minx + maxx) / 2 AS lon, (miny + maxy) / 2 AS lat FROM building_geom UNION ALL
    SELECT md5(concat('r|', CAST(road_id AS VARCHAR), '|0')), 'road_endpoint', road_id, x1, y1 FROM road UNION ALL
    SELECT md5(concat('r|', CAST(road_id AS VARCHAR), '|1')), 'road_endpoint', road_id, x2, y2 FROM road"""


def nodes(t):
    return gr.graph_nodes_build(t.building_geom, t.road)


@query("graph_nodes_build", NODES, "lon lat")
def _(t):
    return nodes(t)


EDGES = f"""SELECT r.road_id, oneway, a.node_id AS f, b.node_id AS t, {spheroid('x1', 'y1', 'x2', 'y2')} AS weight FROM road AS r
    JOIN ({NODES}) AS a ON a.lon = x1 AND a.lat = y1 JOIN ({NODES}) AS b ON b.lon = x2 AND b.lat = y2"""


@query("graph_road_edges", f"""SELECT md5(concat_ws('|', road_id, from_node, to_node)) AS edge_id, * FROM (
    SELECT f AS from_node, t AS to_node, weight, 'road' AS edge_type, road_id AS ref_id, road_id FROM ({EDGES}) UNION ALL
    SELECT t, f, weight, 'road', road_id, road_id FROM ({EDGES}) WHERE oneway = 'B')""", "weight")
def _(t):
    return gr.graph_road_edges(t.road, nodes(t)).withColumn("road_id", F.col("ref_id"))


@query("join_geometry_equality", f"SELECT road_id, f AS from_node, t AS to_node FROM ({EDGES})")
def _(t):
    return join_geometry_equality(t.road, nodes(t)).select("road_id", "from_node", "to_node")


POINTS = f"(SELECT node_id, ref_id, node_type, lon, lat FROM ({NODES}))"
CACHE = f"""SELECT node_id, ref_id, node_type, lon, lat, b.building_id, r.road_id AS nearest_road_id,
    {spheroid('lon', 'lat', 'b.cx', 'b.cy')} AS distance_to_bldg, {spheroid('lon', 'lat', 'r.cx', 'r.cy')} AS distance_to_road
    FROM {POINTS} AS n, LATERAL (SELECT building_id, greatest(minx, least(n.lon, maxx)) AS cx, greatest(miny, least(n.lat, maxy)) AS cy
      FROM building_geom ORDER BY sqrt((cx - n.lon) * (cx - n.lon) + (cy - n.lat) * (cy - n.lat)), building_id LIMIT 1) AS b,
    LATERAL (SELECT road_id, x1 + u * (x2 - x1) AS cx, y1 + u * (y2 - y1) AS cy FROM (SELECT *, greatest(0.0, least(1.0,
      coalesce(((n.lon - x1) * (x2 - x1) + (n.lat - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0))) AS u FROM road)
      ORDER BY sqrt((cx - n.lon) * (cx - n.lon) + (cy - n.lat) * (cy - n.lat)), road_id LIMIT 1) AS r"""


#: Where each application has stored its node cache, by folder of the tables.
STORED: dict[tuple[str, str], str] = {}


def cache(t):
    """The cache is a stored table: it is written once in an application and read by all its users."""
    own = (t.spark.sparkContext.applicationId, t.sf_dir)
    if own not in STORED:
        path = scratch_path(t.spark, "node-cache")
        gr.node_spatial_cache(nodes(t), t.building_geom, t.road).write.parquet(path)
        STORED[own] = path
    return t.spark.read.parquet(STORED[own])


@query("node_spatial_cache", f"SELECT node_id, lon, lat, building_id, nearest_road_id, distance_to_bldg, distance_to_road FROM ({CACHE})",
       "lon lat distance_to_bldg distance_to_road")
def _(t):
    return gr.node_spatial_cache(nodes(t), t.building_geom, t.road)


@query("cache_coverage_check", f"""SELECT count(*) AS nodes, count(*) AS with_road, CAST(0 AS BIGINT) AS without_road FROM ({NODES})""")
def _(t):
    return gr.cache_coverage_check(cache(t))


@query("snap_node_to_building", f"""SELECT node_id, building_id, distance_to_bldg AS distance_m FROM ({CACHE}) WHERE node_type = 'road_endpoint'""", "distance_m")
def _(t):
    from terrawatt.operators.spatial import snap_node_to_building

    wanted = nodes(t).where("node_type = 'road_endpoint'").select("node_id")
    return snap_node_to_building(nodes(t), wanted, t.building_geom).select("node_id", "building_id", "distance_m")


@query("enrich_nodes", f"""SELECT node_id, minx, miny, maxx, maxy FROM ({NODES}) AS n JOIN building_geom AS g ON g.building_id = n.ref_id
    WHERE node_type = 'building_centroid'""", "minx miny maxx maxy")
def _(t):
    ids = t.building_geom.select(natural_id(F.lit("b"), F.col("building_id")).alias("node_id"))
    return gr.enrich_nodes(nodes(t), t.building_geom, ids)


@query("graph_views", """SELECT src, dst, weight, e_type, epoch_ms(timestamp) AS timestamp_ms FROM edges""", "weight")
def _(t):
    return gr.graph_views(t.vertices, t.edges)[1]


@query("graph_degree", """SELECT v.id, count(e.v) AS degree FROM vertices AS v LEFT JOIN (SELECT src AS v FROM edges UNION ALL
    SELECT dst FROM edges WHERE src <> dst) AS e ON e.v = v.id GROUP BY v.id""")
def _(t):
    return gr.graph_degree(t.vertices, t.edges)


@query("graph_simple_score", "SELECT id, value AS score FROM vertices", "score")
def _(t):
    return gr.graph_simple_score(t.vertices)


DEGREE = """(SELECT v.id, count(e.v) AS degree FROM vertices AS v LEFT JOIN (SELECT src AS v FROM edges UNION ALL
    SELECT dst FROM edges WHERE src <> dst) AS e ON e.v = v.id GROUP BY v.id)"""


@query("graph_metrics", f"""SELECT id, degree / ((SELECT count(*) FROM vertices) - 1) AS centrality, CASE WHEN degree > 0 THEN
    (SELECT count(DISTINCT v) - 1 FROM (SELECT src AS v FROM edges UNION ALL SELECT dst FROM edges)) / ((SELECT count(*) FROM vertices) - 1)
    ELSE 0.0 END AS reachability_score FROM {DEGREE} AS d""", "centrality reachability_score")
def _(t):
    # The part-supplier graph has one component besides isolated vertices, which the SQL states.
    return gr.graph_metrics(t.vertices, t.edges)


@query("graph_metrics__k_hops")
def _(t):
    return gr.graph_metrics(t.vertices, t.edges, k=2)


@query("connected_components", """WITH RECURSIVE link AS (SELECT r.road_id AS a, p.to_id AS b FROM road AS r JOIN road_pair AS p ON p.road_id = r.road_id),
    both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link), reach(id, seen) AS (SELECT id, id FROM points UNION
    SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen)
    SELECT id, min(seen) AS component FROM reach GROUP BY id""")
def _(t):
    links = t.road_pair.join(t.road.select("road_id"), "road_id").select(F.col("road_id").alias("src"), F.col("to_id").alias("dst"))
    return gr.connected_components(t.points.select("id"), links)


# --- formulas ---------------------------------------------------------------------------

W, V = fm.EdgeField("weight"), fm.VertexField("value")


def formula(name, sql, build, by=None):
    query(name, sql, "value")(lambda t: fm.evaluate(build, t.vertices, t.edges, by))


formula("formula_arith", "SELECT id, (value + 2) * 3 - value / 4 AS value FROM vertices", (V + 2) * 3 - V / 4, by="src")
formula("formula_edge_agg", "SELECT sum(weight * 2) + avg(weight) AS value FROM edges", fm.sum_edges(W * 2) + fm.avg_edges(W))
formula("formula_vertex_agg", "SELECT sum(value) + avg(value) * max(value) AS value FROM vertices",
        fm.sum_vertices(V) + fm.avg_vertices(V) * fm.max_vertices(V))
formula("formula_transform", "SELECT id, ln(abs(value) + 1) + greatest(0, least(1, value / 1000)) AS value FROM "
        "(SELECT id, CASE WHEN value > 0 THEN value ELSE 0 END AS value FROM vertices)",
        fm.log(fm.If(V > 0, V, fm.Const(0)) + 1) + fm.normalize(fm.If(V > 0, V, fm.Const(0)) / 1000), by="src")
formula("formula_compare", """SELECT id, CAST(value > 1000 AS DOUBLE) + CAST(value < 500 AS DOUBLE) * 2 + CAST(value >= 950 AS DOUBLE) * 4
    + CAST(value <= 950 AS DOUBLE) * 8 + CAST(value = 900 AS DOUBLE) * 16 + CAST(value <> 900 AS DOUBLE) * 32 AS value FROM vertices""",
        (V > 1000) + (V < 500) * 2 + (V >= 950) * 4 + (V <= 950) * 8 + V.eq(900) * 16 + V.ne(900) * 32, by="src")
formula("formula_if", "SELECT CASE WHEN avg(weight) > 20 THEN max(weight_max) ELSE 0 END AS value FROM (SELECT weight, (SELECT max(value) FROM vertices) AS weight_max FROM edges)",
        fm.If(fm.avg_edges(W) - 20, fm.max_vertices(V), fm.Const(0)))
formula("model_risk", "SELECT avg(weight) * (SELECT max(value) FROM vertices) AS value FROM edges", fm.model_risk())
formula("model_influence", "SELECT greatest(0, least(1, sum(weight))) AS value FROM edges", fm.model_influence())
formula("model_influence__by_vertex", """SELECT v.id, greatest(0, least(1, coalesce(w, 0))) AS value FROM vertices AS v
    LEFT JOIN (SELECT src, sum(weight) AS w FROM edges GROUP BY src) AS e ON e.src = v.id""", fm.model_influence(), by="src")
formula("formula_by_vertex", """SELECT v.id, coalesce(w, 0) * v.value / (SELECT max(value) FROM vertices) AS value FROM vertices AS v
    LEFT JOIN (SELECT dst, avg(weight) AS w FROM edges GROUP BY dst) AS e ON e.dst = v.id""",
        fm.avg_edges(W) * V / fm.max_vertices(V), by="dst")


# --- scores and read models -------------------------------------------------------------

CENTROID = f"(SELECT ref_id AS building_id, distance_to_road, nearest_road_id FROM ({CACHE}) WHERE node_type = 'building_centroid')"


@query("building_accessibility", f"""SELECT b.building_id, c.distance_to_road, c.nearest_road_id, r.road_type, r.maxspeed FROM building AS b
    JOIN {CENTROID} AS c ON c.building_id = b.building_id
    LEFT JOIN road AS r ON r.road_id = c.nearest_road_id""", "distance_to_road")
def _(t):
    return gr.building_accessibility(t.building, nodes(t), cache(t), t.road)


@query("risk_score", f"SELECT b.building_id, 1 / (1 + distance_to_road) AS risk_score FROM building AS b LEFT JOIN {CENTROID} AS c ON c.building_id = b.building_id", "risk_score")
def _(t):
    return gr.risk_score(t.building, nodes(t), cache(t))


@query("accessibility_score", f"SELECT b.building_id, 1 / (1 + distance_to_road) AS accessibility_score FROM building AS b LEFT JOIN {CENTROID} AS c ON c.building_id = b.building_id", "accessibility_score")
def _(t):
    return gr.accessibility_score(t.building, nodes(t), cache(t))


METRICS = f"""SELECT b.building_id, 1 / (1 + distance_to_road) AS risk_score, 1 / (1 + distance_to_road) AS accessibility_score,
    TIMESTAMP '{AS_OF}' AS updated_at FROM building AS b LEFT JOIN {CENTROID} AS c ON c.building_id = b.building_id"""


@query("building_metrics_refresh", METRICS, "risk_score accessibility_score")
def _(t):
    old = t.building.where("building_id % 2 = 0").select(
        "building_id", F.lit(-1.0).alias("risk_score"), F.lit(-1.0).alias("accessibility_score"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    return gr.building_metrics_refresh(t.building, nodes(t), cache(t), AS_OF, old)


DENSITY = f"""SELECT a.building_id, count(b.building_id) AS n FROM building_geom AS a LEFT JOIN building_geom AS b
    ON a.building_id <> b.building_id AND abs(a.miny - b.miny) < 0.02 AND abs(a.minx - b.minx) < 0.02 AND
    {spheroid('(a.minx + a.maxx) / 2', '(a.miny + a.maxy) / 2', '(b.minx + b.maxx) / 2', '(b.miny + b.maxy) / 2')} <= 1000 GROUP BY a.building_id"""


@query("feature_store_refresh", f"""SELECT entity_id, 'BUILDING' AS entity_type, feature_name, feature_value, TIMESTAMP '{AS_OF}' AS computed_at FROM (
    SELECT building_id AS entity_id, 'distance_to_road' AS feature_name, distance_to_road AS feature_value FROM {CENTROID} UNION ALL
    SELECT building_id, 'accessibility', 1 / (1 + distance_to_road) FROM {CENTROID} UNION ALL
    SELECT building_id, 'building_density', CAST(n AS DOUBLE) FROM ({DENSITY}))""", "feature_value")
def _(t):
    return gr.feature_store_refresh(t.building, t.building_geom, nodes(t), cache(t), AS_OF, density_radius_m=1000)


BOXES = "minx, miny, maxx, maxy"


@query("api_building", f"""SELECT b.building_id, name, {BOXES}, risk_score FROM building AS b JOIN building_geom AS g ON g.building_id = b.building_id
    LEFT JOIN ({METRICS}) AS m ON m.building_id = b.building_id""", "minx miny maxx maxy risk_score")
def _(t):
    metrics = gr.building_metrics_refresh(t.building, nodes(t), cache(t), AS_OF)
    return gr.api_building(t.building, t.building_geom, metrics)


@query("api_building_enriched", f"""SELECT b.building_id, name, {BOXES}, risk_score, accessibility_score, centrality, reachability_score
    FROM building AS b JOIN building_geom AS g ON g.building_id = b.building_id LEFT JOIN ({METRICS}) AS m ON m.building_id = b.building_id
    LEFT JOIN (SELECT node_id, ref_id FROM ({NODES}) WHERE node_type = 'building_centroid') AS n ON n.ref_id = b.building_id LEFT JOIN (SELECT md5(concat('b|', CAST(building_id AS VARCHAR))) AS node_id,
    CAST(building_id AS DOUBLE) / 1000 AS centrality, CAST(building_id AS DOUBLE) / 2000 AS reachability_score FROM building) AS gm ON gm.node_id = n.node_id""",
       "minx miny maxx maxy risk_score accessibility_score centrality reachability_score")
def _(t):
    metrics = gr.building_metrics_refresh(t.building, nodes(t), cache(t), AS_OF)
    scored = t.building.select(
        natural_id(F.lit("b"), F.col("building_id")).alias("node_id"), (F.col("building_id") / 1000).alias("centrality"),
        (F.col("building_id") / 2000).alias("reachability_score"),
    )
    return gr.api_building_enriched(t.building, t.building_geom, metrics, nodes(t), scored)


@query("api_building_features", f"""SELECT building_id, 'distance_to_road' AS feature_name, distance_to_road AS feature_value, TIMESTAMP '{AS_OF}' AS computed_at FROM {CENTROID} UNION ALL
    SELECT building_id, 'accessibility', 1 / (1 + distance_to_road), TIMESTAMP '{AS_OF}' FROM {CENTROID} UNION ALL
    SELECT building_id, 'building_density', CAST(n AS DOUBLE), TIMESTAMP '{AS_OF}' FROM ({DENSITY})""", "feature_value")
def _(t):
    from terrawatt.operators.joins import join_multi_key_const

    store = gr.feature_store_refresh(t.building, t.building_geom, nodes(t), cache(t), AS_OF, density_radius_m=1000)
    return join_multi_key_const(t.building.select("building_id"), store)
