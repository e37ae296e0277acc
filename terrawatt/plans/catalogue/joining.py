"""Joins, intervals and set operations."""

from pyspark.sql import functions as F

from terrawatt.operators import intervals as iv
from terrawatt.operators import joins as jn
from terrawatt.operators import setops as so
from terrawatt.operators.aggregates import agg_invoice_total, agg_reconciliation, update_invoice_totals
from terrawatt.operators.changes import cdc_parse_debezium, parse_producer
from terrawatt.plans import marts
from terrawatt.plans.catalogue import shares as s
from terrawatt.plans.registry import query

AS_OF = "1998-06-01"


@query("join_inner_equi", """SELECT community_id, city_name, emirate_name FROM community AS co JOIN city AS ci ON ci.city_id = co.city_id
    JOIN emirate AS e ON e.emirate_id = ci.emirate_id""")
def _(t):
    joined = jn.join_inner_equi(t.community, (t.city, "city_id"), (t.emirate, "emirate_id"))
    return joined.select("community_id", "city_name", "emirate_name")


@query("join_left_star", """SELECT co.community_id, area_km2, total_population, active_companies, total_supply_m2, sector_name
    FROM community AS co LEFT JOIN sector AS se ON se.sector_id = co.sector_id
    LEFT JOIN community_geom AS g ON g.community_id = co.community_id
    LEFT JOIN community_population AS p ON p.community_id = co.community_id
    LEFT JOIN active_companies AS ac ON ac.community_id = co.community_id
    LEFT JOIN community_supply AS su ON su.community_id = co.community_id""", "area_km2 total_supply_m2")
def _(t):
    star = jn.join_left_star(t.community, {
        "sector": (t.sector, "sector_id"), "geom": (t.community_geom, "community_id"),
        "population": (t.community_population, "community_id"), "companies": (t.active_companies, "community_id"),
        "supply": (t.community_supply, "community_id"),
    })
    return star.select("community_id", "area_km2", "total_population", "active_companies", "total_supply_m2", "sector_name")


@query("join_on_true_scalar", """SELECT plot_id, (SELECT count(*) FROM plot) AS total_plots, (SELECT max(land_area_m2) FROM plot) AS largest FROM plot""", "largest")
def _(t):
    one = t.plot.agg(F.count(F.lit(1)).alias("total_plots"), F.max("land_area_m2").alias("largest"))
    return jn.join_on_true_scalar(t.plot.select("plot_id"), one)


@query("join_on_true_fanout", f"SELECT company_id, st.* FROM company LEFT JOIN ({s.SIZES}) AS st ON TRUE")
def _(t):
    return jn.join_on_true_fanout(t.company.select("company_id"), marts.company_size_distribution(t.company))


@query("join_multi_child_fanout", """SELECT p.population_id, nationality_group, age_group, gender FROM population AS p
    LEFT JOIN demographics AS d ON d.population_id = p.population_id LEFT JOIN age_distribution AS a ON a.population_id = p.population_id
    LEFT JOIN gender_split AS g ON g.population_id = p.population_id""")
def _(t):
    children = [c.drop("people_count") for c in (t.demographics, t.age_distribution, t.gender_split)]
    return jn.join_multi_child_fanout(t.population.select("population_id"), "population_id", children)


@query("join_on_json_key", """SELECT ingest_id, name, floor_area_m2 FROM features JOIN (SELECT CAST(building_id AS VARCHAR) AS osm_id, name,
    floor_area_m2 FROM building) AS b ON json_extract_string(payload, '$.osm_id') = b.osm_id""", "floor_area_m2")
def _(t):
    buildings = t.building.select(F.col("building_id").cast("string").alias("osm_id"), "name", "floor_area_m2")
    return jn.join_on_json_key(t.features, buildings, "$.osm_id", "osm_id").select("ingest_id", "name", "floor_area_m2")


@query("join_using_optional", """SELECT b.building_id, name, minx, miny, risk_score FROM building AS b
    JOIN building_geom AS g ON g.building_id = b.building_id
    LEFT JOIN (SELECT id AS building_id, total_area_km2 AS risk_score FROM zone WHERE id % 3 = 0) AS m ON m.building_id = b.building_id""",
       "minx miny risk_score")
def _(t):
    metrics = t.zone.where("id % 3 = 0").select(F.col("id").alias("building_id"), F.col("total_area_km2").alias("risk_score"))
    return t.building.join(t.building_geom, "building_id").join(metrics, "building_id", "left").select(
        "building_id", "name", "minx", "miny", "risk_score"
    )


@query("join_multi_key_const", """SELECT b.building_id, 'area' AS feature_name, total_area_km2 AS feature_value, DATE '2024-01-01' AS computed_at
    FROM building AS b JOIN zone AS z ON z.id = b.building_id WHERE z.id % 2 = 0""", "feature_value")
def _(t):
    store = t.zone.select(
        F.col("id").alias("entity_id"), F.when(F.col("id") % 2 == 0, "BUILDING").otherwise("PARCEL").alias("entity_type"),
        F.lit("area").alias("feature_name"), F.col("total_area_km2").alias("feature_value"),
        F.lit("2024-01-01").cast("date").alias("computed_at"),
    )
    return jn.join_multi_key_const(t.building.select("building_id"), store)


@query("join_full_outer_changes", """SELECT coalesce(i.id, d.id) AS id, CASE WHEN i.id IS NOT NULL AND d.id IS NOT NULL THEN 'UPDATE'
    WHEN i.id IS NOT NULL THEN 'INSERT' ELSE 'DELETE' END AS operation FROM (SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 <> 0) AS i
    FULL JOIN (SELECT c_custkey AS id FROM customer WHERE c_custkey % 2 = 0) AS d ON i.id = d.id""")
def _(t):
    ids = t.customer.select(F.col("c_custkey").alias("id"))
    return jn.join_full_outer_changes(ids.where("id % 3 <> 0"), ids.where("id % 2 = 0"), "id")


ACTIVE = f"status = 'Active' AND (end_date IS NULL OR end_date >= DATE '{AS_OF}')"


@query("semi_active_contract", f"""SELECT c_custkey AS customer_id, c_custkey IN (SELECT customer_id FROM contract WHERE {ACTIVE}) AS has_active
    FROM customer""")
def _(t):
    return iv.semi_active_contract(t.customer.select(F.col("c_custkey").alias("customer_id")), t.contract, AS_OF)


@query("semi_active_contract__any_end", """SELECT c_custkey AS customer_id, c_custkey IN (SELECT customer_id FROM contract
    WHERE status = 'Active') AS has_active FROM customer""")
def _(t):
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"))
    return iv.semi_active_contract(customers, t.contract, AS_OF, check_end_date=False)


@query("semi_in_subquery", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return jn.semi_in_subquery(t.orders, wanted, "o_custkey").select("o_orderkey")


@query("anti_conflict_do_nothing", """SELECT id, 'old' AS origin FROM points WHERE id % 2 = 0 UNION ALL
    SELECT id, 'new' FROM points WHERE id % 3 = 0 AND id % 2 <> 0""")
def _(t):
    old = t.points.where("id % 2 = 0").select("id", F.lit("old").alias("origin"))
    new = t.points.where("id % 3 = 0").select("id", F.lit("new").alias("origin"))
    return jn.anti_conflict_do_nothing(old, new, "id")


@query("interval_active_meters", f"SELECT * FROM customer_meter WHERE end_date IS NULL OR end_date >= DATE '{AS_OF}'")
def _(t):
    return iv.interval_active_meters(t.customer_meter, AS_OF)


TARIFF = f"""SELECT customer_id, tariff_id FROM (SELECT c.customer_id, a.tariff_id, row_number() OVER (PARTITION BY c.customer_id
    ORDER BY a.effective_from DESC, a.assignment_id DESC) AS rn FROM contract AS c JOIN assignment AS a ON a.contract_id = c.contract_id
    WHERE c.status = 'Active' AND a.effective_from <= DATE '{AS_OF}' AND (a.effective_to IS NULL OR a.effective_to >= DATE '{AS_OF}')) WHERE rn = 1"""


@query("asof_active_tariff", TARIFF)
def _(t):
    return iv.asof_active_tariff(t.contract, t.assignment, AS_OF)


@query("cross_apply_tariff_lines", f"""SELECT i.invoice_id, 'Energy Consumption' AS description, 0 AS quantity, r.price_per_kwh AS unit_price
    FROM invoice AS i JOIN ({TARIFF}) AS x ON x.customer_id = i.customer_id JOIN tariff_rate AS r ON r.tariff_id = x.tariff_id
    WHERE r.tou_code_id = 1""", "unit_price")
def _(t):
    return iv.cross_apply_tariff_lines(t.invoice, iv.asof_active_tariff(t.contract, t.assignment, AS_OF), t.tariff_rate)


@query("interval_overlap_check", """SELECT a.contract_id, a.assignment_id AS a_id, b.assignment_id AS b_id FROM assignment AS a
    JOIN assignment AS b ON a.contract_id = b.contract_id WHERE a.assignment_id <> b.assignment_id AND
    (a.effective_from BETWEEN b.effective_from AND b.effective_to OR a.effective_to BETWEEN b.effective_from AND b.effective_to)""")
def _(t):
    return iv.interval_overlap_check(t.assignment)


@query("interval_overlap_check__strict", """SELECT a.customer_id, a.meter_id AS a_id, b.meter_id AS b_id FROM customer_meter AS a
    JOIN customer_meter AS b ON a.customer_id = b.customer_id WHERE a.meter_id < b.meter_id
    AND a.start_date <= coalesce(b.end_date, DATE '9999-01-01') AND b.start_date <= coalesce(a.end_date, DATE '9999-01-01')""")
def _(t):
    return iv.interval_overlap_check(t.customer_meter, "customer_id", "meter_id", "start_date", "end_date", strict=True)


@query("interval_overlap_exists", """SELECT a.contract_id, min(greatest(a.effective_from, b.effective_from)) AS first_overlap FROM assignment AS a
    JOIN assignment AS b ON a.contract_id = b.contract_id WHERE a.assignment_id <> b.assignment_id AND coalesce(a.effective_to >= a.effective_from, TRUE)
    AND coalesce(b.effective_to >= b.effective_from, TRUE)
    AND (a.effective_from BETWEEN b.effective_from AND b.effective_to OR a.effective_to BETWEEN b.effective_from AND b.effective_to) GROUP BY 1""")
def _(t):
    return iv.interval_overlap_exists(t.assignment)


@query("interval_overlap_exists__strict", """SELECT a.customer_id, min(greatest(a.start_date, b.start_date)) AS first_overlap FROM customer_meter AS a
    JOIN customer_meter AS b ON a.customer_id = b.customer_id WHERE a.meter_id < b.meter_id AND coalesce(a.end_date >= a.start_date, TRUE) AND coalesce(b.end_date >= b.start_date, TRUE)
    AND a.start_date <= coalesce(b.end_date, DATE '9999-01-01') AND b.start_date <= coalesce(a.end_date, DATE '9999-01-01') GROUP BY 1""")
def _(t):
    return iv.interval_overlap_exists(t.customer_meter, "customer_id", "start_date", "end_date", strict=True)


@query("lateral_scalar_subquery", """SELECT building_id, (SELECT max(z.total_area_km2) FROM zone AS z WHERE z.id = b.building_id) AS area,
    (SELECT 1 / (1 + max(z.total_area_km2)) FROM zone AS z WHERE z.id = b.building_id) AS score FROM building AS b""", "area score")
def _(t):
    area = F.col("total_area_km2")
    lookup = t.zone.withColumnRenamed("id", "building_id")
    return jn.lateral_scalar_lookup(t.building.select("building_id"), lookup, "building_id", {"area": area, "score": 1 / (1 + area)})


@query("agg_invoice_total", "SELECT invoice_id, CAST(CAST(sum(CAST(quantity AS DECIMAL(12,3)) * CAST(CAST(unit_price AS VARCHAR) AS DECIMAL(12,4))) AS DECIMAL(12,2)) AS DOUBLE) AS total_amount FROM invoice_lines GROUP BY invoice_id", "total_amount")
def _(t):
    return agg_invoice_total(t.invoice_lines)


@query("agg_invoice_total__touched", """SELECT i.invoice_id, CAST(CASE WHEN i.invoice_id % 5 = 0 THEN x.total ELSE 0.0 END AS DOUBLE) AS total_amount
    FROM invoice AS i LEFT JOIN (SELECT invoice_id, CAST(sum(CAST(quantity AS DECIMAL(12,3)) * CAST(CAST(unit_price AS VARCHAR) AS DECIMAL(12,4))) AS DECIMAL(12,2)) AS total FROM invoice_lines GROUP BY 1) AS x
    ON x.invoice_id = i.invoice_id""", "total_amount")
def _(t):
    headers = t.invoice.select("invoice_id", F.lit(0).cast("decimal(12,2)").alias("total_amount"))
    touched = t.invoice.where("invoice_id % 5 = 0").select("invoice_id")
    return update_invoice_totals(headers, t.invoice_lines, touched)


@query("agg_reconciliation", """SELECT coalesce(b.customer_id, m.customer_id) AS customer_id, coalesce(b.period, m.period) AS period,
    billed_kwh, measured_kwh, measured_kwh - billed_kwh AS difference FROM billed AS b FULL JOIN measured AS m
    ON m.customer_id = b.customer_id AND m.period = b.period""", "billed_kwh measured_kwh difference")
def _(t):
    return agg_reconciliation(t.billed, t.measured)


# --- set operations ---------------------------------------------------------------------


def unified(t):
    return so.union_all_unified_sources(cdc_parse_debezium(t.cdc_json), parse_producer(t.producer_json))


def _dec(path: str, scale: int) -> str:
    return f"TRY_CAST(json_extract_string(payload, '$.after.{path}') AS DECIMAL(18,{scale}))"


CDC_ROWS = f"""SELECT CAST(json_extract_string(payload, '$.after.id') AS BIGINT) AS id,
    json_extract_string(payload, '$.after.meter_id') AS meter_id,
    make_timestamp(CAST(json_extract_string(payload, '$.after.timestamp') AS BIGINT) // 1000) AS timestamp,
    {_dec('energy_consumption', 2)} AS energy_consumption, {_dec('voltage', 2)} AS voltage, {_dec('current_reading', 2)} AS current_reading,
    {_dec('power_factor', 3)} AS power_factor, {_dec('frequency', 2)} AS frequency,
    json_extract_string(payload, '$.after.status') AS status, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
    json_extract_string(payload, '$.op') AS cdc_operation, 'mssql_cdc' AS cdc_source
    FROM cdc_json WHERE json_extract_string(payload, '$.op') IN ('c', 'u', 'r')"""
PRODUCER_ROWS = """SELECT json_extract_string(payload, '$.meter_id') AS meter_id,
    CAST(json_extract_string(payload, '$.timestamp') AS TIMESTAMP) AS timestamp,
    CAST(json_extract_string(payload, '$.kwh_usage') AS DECIMAL(18,2)) AS kwh_usage,
    CAST(json_extract_string(payload, '$.voltage') AS INTEGER) AS voltage,
    json_extract_string(payload, '$.customer_id') AS customer_id, json_extract_string(payload, '$.region') AS region,
    'kafka_producer' AS source FROM producer_json"""
UNIFIED = f"""SELECT meter_id, timestamp, NULL AS region, NULL AS customer_id, CAST(energy_consumption AS DOUBLE) AS consumption_kwh,
    CAST(voltage AS DOUBLE) AS voltage, CAST(current_reading AS DOUBLE) AS current_amps, CAST(power_factor AS DOUBLE) AS power_factor,
    CAST(frequency AS DOUBLE) AS frequency, status, id AS cdc_id, created_at, updated_at, 'mssql_cdc' AS data_source,
    cdc_operation AS operation_type FROM ({CDC_ROWS})
    UNION ALL SELECT meter_id, timestamp, region, customer_id, CAST(kwh_usage AS DOUBLE), CAST(voltage AS DOUBLE), NULL, NULL, NULL,
    'active', NULL, timestamp, timestamp, 'kafka_producer', 'c' FROM ({PRODUCER_ROWS})"""


@query("union_all_unified_sources", UNIFIED, "consumption_kwh voltage current_amps power_factor frequency")
def _(t):
    return unified(t)


@query("agg_daily_consumption_view", f"""SELECT CAST(timestamp AS DATE) AS consumption_date, region, data_source,
    count(DISTINCT meter_id) AS unique_meters, count(DISTINCT customer_id) AS unique_customers, sum(consumption_kwh) AS total_energy_kwh,
    avg(voltage) AS avg_voltage, avg(current_amps) AS avg_current_amps, max(consumption_kwh) AS max_consumption_kwh,
    count(*) AS total_readings FROM ({UNIFIED}) GROUP BY ALL""", "total_energy_kwh avg_voltage avg_current_amps max_consumption_kwh")
def _(t):
    from terrawatt.operators.aggregates import agg_daily_consumption_view

    rows = unified(t)
    return agg_daily_consumption_view(rows.withColumns({c: F.col(c).cast("double") for c in ("consumption_kwh", "voltage", "current_amps")}))


@query("agg_system_overview", f"""SELECT data_source, count(*) AS total_records, min(timestamp) AS earliest_record,
    max(timestamp) AS latest_record, count(DISTINCT meter_id) AS unique_meters, count(DISTINCT region) AS unique_regions
    FROM ({UNIFIED}) GROUP BY data_source""")
def _(t):
    from terrawatt.operators.aggregates import agg_system_overview

    return agg_system_overview(unified(t))


@query("union_all_edges_reverse", """SELECT road_id, x1 AS from_node, x2 AS to_node FROM road UNION ALL
    SELECT road_id, x2, x1 FROM road WHERE oneway = 'B'""", "from_node to_node")
def _(t):
    edges = t.road.select("road_id", "oneway", F.col("x1").alias("from_node"), F.col("x2").alias("to_node"))
    return so.union_all_edges_reverse(edges, F.col("oneway") == "B").select("road_id", "from_node", "to_node")


@query("union_distinct_touched_keys", """SELECT invoice_id FROM invoice_lines WHERE quantity > 45 UNION
    SELECT invoice_id FROM invoice_lines WHERE quantity < 3""")
def _(t):
    lines = t.invoice_lines
    return so.union_distinct_touched_keys(lines.where("quantity > 45"), lines.where("quantity < 3"), "invoice_id")
