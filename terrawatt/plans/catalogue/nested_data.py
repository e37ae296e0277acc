"""HTML and JSON extraction."""

from pyspark.sql import functions as F

from terrawatt.operators import cleaning as cl
from terrawatt.operators import nested as ns
from terrawatt.plans.registry import query


@query("html_embedded_json", """SELECT page_id, concat('{"id":', CAST(page_id AS VARCHAR), ',"price":', CAST(page_id * 10 AS VARCHAR), '}') AS listing
    FROM pages WHERE page_id % 3 <> 0""")
def _(t):
    # The crawl has no embedded listing, so one is put into two thirds of its pages.
    blob = F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"listing":{"id":'), F.col("page_id").cast("string"),
        F.lit(',"price":'), (F.col("page_id") * 10).cast("string"), F.lit("}}}}</script>"),
    )
    html = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(F.replace("html", F.lit("</head>"), F.concat(blob, F.lit("</head>"))))
    return ns.html_embedded_json(t.pages.select("page_id", html.alias("html")))


@query("html_listing_fields", """SELECT page_id, 'listing-pages' AS source, '1 200 EUR' AS price, 'Flat' AS property_type, CAST(page_id AS VARCHAR) AS area_sqm,
    CAST(NULL AS VARCHAR) AS city, 'Old & New' AS district, 'Bright rooms' AS description, concat('42.', CAST(page_id AS VARCHAR)) AS latitude,
    concat('23.', CAST(page_id AS VARCHAR)) AS longitude FROM pages""")
def _(t):
    extra = F.concat(
        F.lit('<div class="price"> 1 200 <b>EUR</b></div><ul class="property-params"><li><span class="label">Property Type</span>'
              '<span class="value">Flat</span></li><li><span class="label">AREA</span><span class="value">'),
        F.col("page_id").cast("string"),
        F.lit('</span></li><li><span class="label">District</span><span class="value">Old &amp; New</span></li></ul>'
              '<div class="description"><p>Bright rooms</p></div><div id="map" data-lat="42.'),
        F.col("page_id").cast("string"), F.lit('" data-lng="23.'), F.col("page_id").cast("string"), F.lit('"></div>'),
    )
    pages = t.pages.select("page_id", F.concat("html", extra).alias("html"))
    return ns.html_listing_fields(pages).drop("title")


@query("html_listing_title")
def _(t):
    return ns.html_listing_fields(t.pages.select("page_id", "html")).select("page_id", "title")


@query("json_pages_explode", """SELECT page_no, n * 37 AS total, CAST(ceil(n * 37 / 50) AS BIGINT) AS pages, id, name FROM (
    SELECT p_partkey % 50 AS page_no, count(*) AS n, min(p_partkey) AS id, 'a' AS name FROM part GROUP BY 1 UNION ALL
    SELECT p_partkey % 50, count(*), max(p_partkey), 'b' FROM part GROUP BY 1)""")
def _(t):
    return ns.json_pages_explode(t.item_pages, "struct<id:bigint,name:string>")


@query("ckan_resource_pick", """SELECT s_suppkey AS dataset_id, CASE WHEN s_suppkey % 4 <> 0 THEN concat('u', CAST(s_suppkey AS VARCHAR), '.csv') END AS csv_url FROM supplier""")
def _(t):
    return ns.ckan_resource_pick(t.catalogue_json)


@query("json_array_to_rows", """SELECT 'D' AS district_id, 'Deira' AS district_name, 0 AS pos, concat('{"k":', CAST(s_suppkey AS VARCHAR), '}') AS payload FROM supplier
    UNION ALL SELECT 'D', 'Deira', 1, '{"k":-1}' FROM supplier""")
def _(t):
    payload = F.concat(F.lit('[{"k":'), F.col("s_suppkey").cast("string"), F.lit('},{"k":-1}]'))
    rows = t.supplier.select(F.lit("D").alias("district_id"), F.lit("Deira").alias("district_name"), payload.alias("payload"))
    return ns.json_array_to_rows(rows)


@query("unpivot_fields_by_tag", """SELECT CAST(p_partkey AS VARCHAR) AS plot_id, concat('D', CAST(p_partkey % 9 AS VARCHAR)) AS district_id,
    concat('District ', CAST(p_partkey % 9 AS VARCHAR)) AS district_name, p_name AS plot_number, CAST(p_partkey * 3 AS DOUBLE) AS land_id,
    p_type AS land_use_type, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS purpose, concat('S', CAST(p_size % 3 AS VARCHAR)) AS cadastral_status,
    CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS foreign_eligible, CAST(NULL AS VARCHAR) AS description FROM part""", "land_id")
def _(t):
    return cl.unpivot_fields_by_tag(t.cadastral_raw)


@query("filter_feature_type", """SELECT md5(concat('building|', CAST(ingest_id AS VARCHAR))) AS building_id, json_extract_string(payload, '$.name') AS name,
    json_extract_string(payload, '$.fclass') AS building_type, 'active' AS status, json_extract_string(payload, '$.osm_id') AS osm_id
    FROM features WHERE source_system LIKE 'OSM_Dubai_Buildings%'""")
def _(t):
    return cl.filter_feature_type(cl.classify_source_like(t.features, "source_system"), "building")


@query("filter_feature_type__landuse", """SELECT md5(concat('parcel|', CAST(ingest_id AS VARCHAR))) AS parcel_id, json_extract_string(payload, '$.fclass') AS zoning
    FROM features WHERE source_system LIKE 'OSM_Dubai_Landuse%'""")
def _(t):
    return cl.filter_feature_type(cl.classify_source_like(t.features, "source_system"), "landuse")


@query("classify_source_like", """SELECT ingest_id, CASE WHEN source_system LIKE 'OSM_Dubai_Buildings%' THEN 'building'
    WHEN source_system LIKE 'OSM_Dubai_Roads%' THEN 'road' WHEN source_system LIKE 'OSM_Dubai_POIs%' THEN 'poi'
    WHEN source_system LIKE 'OSM_Dubai_Landuse%' THEN 'landuse' END AS feature_type FROM features""")
def _(t):
    return cl.classify_source_like(t.features, "source_system").select("ingest_id", "feature_type")


@query("tri_state_bool", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN TRUE WHEN p_partkey % 3 = 1 THEN FALSE END AS flag FROM part""")
def _(t):
    from terrawatt.functions.scalar import tri_state_bool

    text = F.when(F.col("p_partkey") % 3 == 0, "YES").when(F.col("p_partkey") % 3 == 1, "No").otherwise("maybe")
    return t.part.select("p_partkey", tri_state_bool(text).alias("flag"))


@query("filter_subtype_project", """SELECT concat('n', CAST(n_nationkey AS VARCHAR)) AS id, n_name AS name, concat('ar ', n_name) AS name_ar,
    CAST(n_nationkey AS DOUBLE) AS lon, 25.5 AS lat, 'POINT(1 2)' AS wkt FROM nation WHERE n_nationkey % 2 = 0""", "lon lat")
def _(t):
    items = t.nation.select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
        F.when(F.col("n_nationkey") % 2 == 0, "district").otherwise("street").alias("subtype"),
        F.col("n_name").alias("name"), F.concat(F.lit("ar "), F.col("n_name")).alias("name[ar]"),
        F.struct(F.col("n_nationkey").cast("double").alias("lon"), F.lit(25.5).alias("lat")).alias("point"),
        F.struct(F.lit("POINT(1 2)").alias("selection")).alias("geometry"),
    )
    return cl.filter_subtype_project(items)
