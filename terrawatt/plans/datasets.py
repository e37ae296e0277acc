"""Derived input datasets over the base tables.

Each is one SELECT that Spark SQL and DuckDB both accept, so the plans and their oracles start
from the same rows. They only map generic tables onto the domain's column names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Instants that stand in for "now"; the event stream covers January 2024.
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_SALES = "2001-08-01"

DATASETS: dict[str, str] = {
    # --- metering -----------------------------------------------------------------------
    "meter_readings": """
        SELECT event_id,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    ELSE concat('METER_', lpad(CAST(user_id AS STRING), 3, '0')) END AS meter_id,
               ts AS timestamp,
               CASE WHEN event_id % 53 = 0 THEN NULL
                    WHEN event_id % 101 = 0 THEN -value ELSE value END AS energy_consumption,
               CASE WHEN event_id % 59 = 0 THEN NULL
                    ELSE CAST(190 + event_id % 70 AS DOUBLE) END AS voltage,
               CASE WHEN event_id % 61 = 0 THEN NULL
                    ELSE CAST(event_id % 110 AS DOUBLE) END AS current_reading,
               CASE WHEN event_id % 67 = 0 THEN NULL
                    ELSE CAST(85 + event_id % 15 AS DOUBLE) / 100 END AS power_factor,
               CASE WHEN event_id % 71 = 0 THEN NULL
                    ELSE CAST(495 + event_id % 10 AS DOUBLE) / 10 END AS frequency
        FROM events""",
    "network_events": """
        SELECT event_id, user_id AS device_id, event_type AS device_type,
               concat('R', CAST(user_id % 5 AS STRING)) AS region, ts AS event_time,
               CASE WHEN event_id % 83 = 0 THEN NULL
                    ELSE CAST(event_id * 7 % 100 AS DOUBLE) END AS signal_strength,
               value * 5 AS data_usage_mb,
               CAST(event_id * 37 % 600 AS DOUBLE) AS latency_ms
        FROM events""",
    "telemetry": """
        SELECT event_id AS equipment_id,
               CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_type END AS operator,
               concat('R', CAST(user_id % 5 AS STRING)) AS region,
               value AS cpu_usage, value * 2 AS network_throughput,
               event_id % 1000 AS active_connections
        FROM events""",
    "cdc_json": """
        SELECT event_id, ts,
               concat('{"op":"', CASE WHEN event_id % 11 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'u'
                                      WHEN event_id % 7 = 0 THEN 'r' ELSE 'c' END,
                      '","after":{"id":', CAST(event_id AS STRING),
                      ',"meter_id":"M', CAST(user_id AS STRING),
                      '","timestamp":17040672', lpad(CAST(event_id % 100 AS STRING), 2, '0'), '123456789',
                      ',"energy_consumption":"', CAST(CAST(value AS DECIMAL(10,2)) AS STRING),
                      '","voltage":"', CAST(190 + event_id % 70 AS STRING), '.50"',
                      CASE WHEN event_id % 5 = 0 THEN ''
                           ELSE concat(',"power_factor":"0.', CAST(850 + event_id % 150 AS STRING), '"') END,
                      CASE WHEN event_id % 6 = 0 THEN ',"frequency":""' ELSE ',"frequency":"50.01"' END,
                      ',"current_reading":"', CAST(event_id % 110 AS STRING), '.25","status":"active"}}') AS payload
        FROM events""",
    "producer_json": """
        SELECT event_id, ts,
               concat('{"meter_id":"P', CAST(user_id AS STRING),
                      '","timestamp":"2024-01-', lpad(CAST(1 + event_id % 28 AS STRING), 2, '0'),
                      ' ', lpad(CAST(event_id % 24 AS STRING), 2, '0'), ':00:00"',
                      ',"kwh_usage":', CAST(CAST(value AS DECIMAL(10,2)) AS STRING),
                      ',"voltage":', CAST(215 + event_id % 10 AS STRING),
                      ',"customer_id":"C', CAST(user_id % 40 AS STRING),
                      '","region":"R', CAST(user_id % 5 AS STRING), '"}') AS payload
        FROM events""",
    "change_feed": """
        SELECT event_id AS lsn, user_id AS id,
               CASE WHEN event_id % 11 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS op,
               value, ts AS changed_at
        FROM events""",
    # --- contracts and billing ----------------------------------------------------------
    "contract": """
        SELECT o_orderkey AS contract_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END AS end_date,
               CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Expired' ELSE 'Suspended' END AS status
        FROM orders""",
    "assignment": """
        SELECT contract_id * 2 AS assignment_id, contract_id, contract_id % 7 AS tariff_id,
               start_date AS effective_from, start_date + 120 AS effective_to FROM contract
        UNION ALL
        SELECT contract_id * 2 + 1, contract_id, (contract_id + 1) % 7, start_date + 100,
               CASE WHEN contract_id % 3 = 0 THEN start_date + 110 ELSE NULL END FROM contract""",
    "tariff_rate": """
        SELECT DISTINCT contract_id % 7 AS tariff_id, contract_id % 3 AS tou_code_id,
               CAST(10 + contract_id % 7 + contract_id % 3 AS DOUBLE) / 100 AS price_per_kwh
        FROM contract""",
    "invoice": """
        SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_orderdate AS issued_at FROM orders""",
    "invoice_lines": """
        SELECT l_orderkey AS invoice_id, l_quantity AS quantity,
               l_extendedprice / l_quantity AS unit_price FROM lineitem""",
    "billed": """
        SELECT o_custkey AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
               sum(l_quantity) AS billed_kwh
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 1
        GROUP BY 1, 2""",
    "measured": """
        SELECT o_custkey AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
               sum(l_quantity * (1 + l_tax)) AS measured_kwh
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 2
        GROUP BY 1, 2""",
    "customer_meter": """
        SELECT o_custkey AS customer_id, o_orderkey AS meter_id, CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END AS end_date
        FROM orders""",
    "meter_status": """
        SELECT event_id AS status_id, user_id AS meter_id, ts AS last_seen,
               event_id * 7 % 100 AS signal_strength, event_id % 4 <> 0 AS online
        FROM events""",
    # --- real estate --------------------------------------------------------------------
    "sale": """
        SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_extendedprice AS price_aed,
               l_quantity AS area_m2, l_extendedprice / l_quantity AS price_per_m2,
               CAST(o_orderdate AS DATE) AS transaction_date, l_returnflag AS usage_type,
               l_linestatus AS registration_type, o_orderpriority AS property_type,
               c_nationkey AS community_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "sale_geom": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS sale_id,
               54.9 + CAST(l_orderkey * 7919 % 13000 AS DOUBLE) / 10000 AS lon,
               24.63 + CAST(l_orderkey * 104729 % 7400 AS DOUBLE) / 10000 AS lat
        FROM lineitem WHERE l_orderkey % 5 <> 0""",
    "lease": """
        SELECT l_orderkey * 10 + l_linenumber AS lease_id, l_extendedprice AS annual_rent_aed,
               l_extendedprice * (1 + l_tax) AS total_rent_aed, l_quantity AS area_m2,
               l_extendedprice / l_quantity AS rent_per_m2, l_linestatus AS contract_type,
               l_returnflag AS tenant_type, p_type AS premise_type
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "lease_geom": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS lease_id,
               54.9 + CAST(l_orderkey * 7919 % 13000 AS DOUBLE) / 10000 AS lon,
               24.63 + CAST(l_orderkey * 104729 % 7400 AS DOUBLE) / 10000 AS lat
        FROM lineitem WHERE l_orderkey % 4 <> 0""",
    "company": """
        SELECT c_custkey AS company_id, c_name AS company_name, c_mktsegment AS business_type,
               CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_custkey * 7 % 1200 END AS headcount,
               1 + c_custkey % 5 AS customer_rating, c_nationkey AS community_id
        FROM customer""",
    "building": """
        SELECT p_partkey AS building_id, p_name AS name, p_type AS construction_status,
               p_retailprice AS floor_area_m2, p_size AS properties_count,
               CASE WHEN p_partkey % 41 = 0 THEN NULL
                    ELSE 1990 + p_partkey % 36 END AS completion_year
        FROM part""",
    "building_geom": """
        SELECT p_partkey AS building_id,
               54.9 + CAST(p_partkey * 6841 % 13000 AS DOUBLE) / 10000 AS minx,
               24.63 + CAST(p_partkey * 50021 % 7400 AS DOUBLE) / 10000 AS miny,
               54.9 + CAST(p_partkey * 6841 % 13000 AS DOUBLE) / 10000 + CAST(p_size AS DOUBLE) / 100000 AS maxx,
               24.63 + CAST(p_partkey * 50021 % 7400 AS DOUBLE) / 10000 + CAST(p_size AS DOUBLE) / 100000 AS maxy
        FROM part""",
    "district_area": """
        SELECT n_nationkey AS district_id, 54.9 + CAST(n_nationkey * 4787 % 13000 AS DOUBLE) / 10000 + 0.00003 AS cx,
               24.63 + CAST(n_nationkey * 2903 % 7400 AS DOUBLE) / 10000 + 0.00007 AS cy, 0.02 + CAST(n_nationkey % 7 AS DOUBLE) / 100 AS r
        FROM nation""",
    "development_plan": """
        SELECT p_partkey - p_partkey % 40 AS plan_id, min(p_name) AS plan_name, min(p_brand) AS source FROM part GROUP BY 1""",
    "plan_geom": """
        SELECT p_partkey - p_partkey % 40 AS plan_id,
               CASE WHEN min(p_partkey) % 43 = 0 THEN NULL ELSE CAST(sum(p_size) AS DOUBLE) END AS area_km2
        FROM part GROUP BY 1""",
    "plan_usage": """
        SELECT p_partkey - p_partkey % 40 AS plan_id, p_type AS usage_name, sum(p_retailprice) AS area_m2
        FROM part GROUP BY 1, 2""",
    "zone": """
        SELECT p_partkey AS id, p_name AS name, p_brand AS type,
               CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS total_area_km2
        FROM part""",
    "zone_geom": """
        SELECT p_partkey AS id, CAST(p_size AS DOUBLE) * 1.5 AS area_km2 FROM part WHERE p_partkey % 9 <> 0""",
    "developer": """
        SELECT s_suppkey AS developer_id, concat('Developer ', CAST(s_nationkey AS STRING)) AS developer_name,
               s_name AS zone_name, abs(s_acctbal) AS total_development_area_m2 FROM supplier""",
    "developer_geom": """
        SELECT s_suppkey AS developer_id, abs(s_acctbal) * 1.25 AS area_m2 FROM supplier WHERE s_suppkey % 10 <> 0""",
    "completion_status": """
        SELECT s_suppkey AS developer_id, 'Completed' AS status, abs(s_acctbal) * 0.75 AS area_m2 FROM supplier
        UNION ALL
        SELECT s_suppkey, 'In construction', abs(s_acctbal) * 0.25 FROM supplier WHERE s_suppkey % 3 <> 0""",
    "plot": """
        SELECT p_partkey AS plot_id, p_name AS plot_name, p_type AS land_use, p_retailprice AS land_area_m2 FROM part""",
    "plot_geom": """
        SELECT p_partkey AS plot_id, p_retailprice * 1.1 AS area_m2 FROM part WHERE p_partkey % 6 <> 0""",
    "poi": """
        SELECT s_suppkey AS poi_id, s_name AS poi_name, n_regionkey AS category,
               abs(s_acctbal) AS avg_weekday_footfall,
               CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE abs(s_acctbal) / 2 END AS avg_weekend_footfall
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "poi_geom": """
        SELECT s_suppkey AS poi_id,
               54.9 + CAST(s_suppkey * 7919 % 13000 AS DOUBLE) / 10000 AS lon,
               24.63 + CAST(s_suppkey * 104729 % 7400 AS DOUBLE) / 10000 AS lat
        FROM supplier WHERE s_suppkey % 5 <> 0""",
    "logistics": """
        SELECT s_suppkey AS logistics_id, s_name AS logistics_name, n_name AS cargo_type,
               abs(s_acctbal) AS annual_throughput_mt
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "supply": """
        SELECT p_partkey AS supply_id, p_name AS supply_name,
               CASE WHEN p_partkey % 2 = 0 THEN 'Sale' ELSE 'Rent' END AS listing_type, p_brand AS subtype,
               p_retailprice AS price_per_m2, p_size AS total_area_m2,
               CAST(p_size AS DOUBLE) / 10 AS estimated_cap_rate
        FROM part""",
    "supply_geom": """
        SELECT p_partkey AS supply_id,
               54.9 + CAST(p_partkey * 7919 % 13000 AS DOUBLE) / 10000 AS lon,
               24.63 + CAST(p_partkey * 104729 % 7400 AS DOUBLE) / 10000 AS lat
        FROM part WHERE p_partkey % 7 <> 0""",
    "population": """
        SELECT n_nationkey AS population_id, n_name AS population_name,
               n_nationkey * 1000 + 500 AS total_population, n_nationkey * 600 AS residents,
               n_nationkey * 400 AS workforce FROM nation""",
    "population_geom": """
        SELECT n_nationkey AS population_id, CAST(n_nationkey AS DOUBLE) * 2 + 1 AS area_km2
        FROM nation WHERE n_nationkey % 6 <> 0""",
    "demographics": """
        SELECT c_nationkey AS population_id, c_mktsegment AS nationality_group, count(*) AS people_count
        FROM customer GROUP BY 1, 2""",
    "age_distribution": """
        SELECT c_nationkey AS population_id, c_custkey % 4 AS age_group, count(*) AS people_count
        FROM customer GROUP BY 1, 2""",
    "gender_split": """
        SELECT c_nationkey AS population_id, c_custkey % 2 AS gender, count(*) AS people_count
        FROM customer GROUP BY 1, 2""",
    "emirate": "SELECT r_regionkey AS emirate_id, r_name AS emirate_name FROM region",
    "city": "SELECT n_nationkey AS city_id, n_name AS city_name, n_regionkey AS emirate_id FROM nation",
    "sector": "SELECT r_regionkey AS sector_id, concat('Sector ', r_name) AS sector_name FROM region WHERE r_regionkey <> 3",
    "community": """
        SELECT s_suppkey AS community_id, s_name AS community_name, s_nationkey AS city_id,
               CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey % 4 END AS sector_id FROM supplier""",
    "community_geom": """
        SELECT s_suppkey AS community_id, abs(s_acctbal) / 100 AS area_km2 FROM supplier WHERE s_suppkey % 8 <> 0""",
    "community_population": """
        SELECT s_suppkey AS community_id, s_suppkey * 100 AS total_population,
               CAST(s_suppkey AS DOUBLE) / 4 AS density FROM supplier WHERE s_suppkey % 5 <> 0""",
    "active_companies": """
        SELECT s_suppkey AS community_id, s_suppkey * 3 AS active_companies FROM supplier WHERE s_suppkey % 7 <> 0""",
    "community_supply": """
        SELECT s_suppkey AS community_id, abs(s_acctbal) AS total_supply_m2 FROM supplier WHERE s_suppkey % 11 <> 0""",
    "district": "SELECT c_custkey AS district_id, c_name AS district_name, c_custkey % 10 AS community_id FROM customer",
    # --- spatial and graph --------------------------------------------------------------
    "points": """
        SELECT c_custkey AS id,
               54.9 + CAST(c_custkey * 7919 % 13000 AS DOUBLE) / 10000 AS lon,
               24.63 + CAST(c_custkey * 104729 % 7400 AS DOUBLE) / 10000 AS lat
        FROM customer""",
    "features": """
        SELECT id AS ingest_id, concat(CASE id % 5 WHEN 0 THEN 'OSM_Dubai_Buildings' WHEN 1 THEN 'OSM_Dubai_Roads'
                    WHEN 2 THEN 'OSM_Dubai_POIs' WHEN 3 THEN 'OSM_Dubai_Landuse' ELSE 'DLD_Parcels' END, '_v1') AS source_system,
               concat('{"osm_id":"', CAST(id AS STRING), '","name":"F', CAST(id AS STRING),
                      '","fclass":"class', CAST(id % 6 AS STRING), '"}') AS payload,
               CASE WHEN id % 20 = 0 THEN NULL ELSE lon END AS lon,
               CASE WHEN id % 20 = 0 THEN NULL ELSE lat END AS lat
        FROM points""",
    "road_pair": """
        SELECT c_custkey AS road_id, (c_custkey * 31 + 17) % (SELECT count(*) FROM customer) AS to_id
        FROM customer""",
    "road": """
        SELECT r.road_id, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2,
               CASE WHEN r.road_id % 2 = 0 THEN 'B' ELSE 'F' END AS oneway,
               40 + r.road_id % 5 * 20 AS maxspeed,
               CASE WHEN r.road_id % 4 = 0 THEN 'primary' ELSE 'residential' END AS road_type
        FROM road_pair AS r JOIN points AS a ON a.id = r.road_id JOIN points AS b ON b.id = r.to_id""",
    "vertices": """
        SELECT concat('p', CAST(p_partkey AS STRING)) AS id, p_retailprice AS value, 'Building' AS v_type FROM part
        UNION ALL
        SELECT concat('s', CAST(s_suppkey AS STRING)), s_acctbal, 'Subscriber' FROM supplier""",
    "edges": """
        SELECT concat('p', CAST(l_partkey AS STRING)) AS src, concat('s', CAST(l_suppkey AS STRING)) AS dst,
               l_quantity AS weight, 'ConnectedTo' AS e_type, l_shipdate AS timestamp FROM lineitem""",
    # --- nested JSON --------------------------------------------------------------------
    "cadastral_raw": """
        SELECT concat('D', CAST(p_partkey % 9 AS STRING)) AS district_id,
               concat('District ', CAST(p_partkey % 9 AS STRING)) AS district_name,
               concat('{"id":"', CAST(p_partkey AS STRING), '","name":"', p_name,
                 '","wkt":"POLYGON((55 25, 55.001 25, 55.001 25.001, 55 25.001, 55 25))","point":{"lon":55.0005,"lat":25.0005}',
                 ',"field_groups":[{"fields":[{"tag":"land_id","caption":"Land","value":"', CAST(p_partkey * 3 AS STRING),
                 '"},{"tag":"land_use_type","caption":"Use","value":"', p_type, '"}]},{"fields":[',
                 CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat('{"tag":"x","caption":"Purpose","value":"', p_brand, '"},') END,
                 '{"tag":"cadastral_status","caption":"Status","value":"S', CAST(p_size % 3 AS STRING),
                 '"},{"tag":"y","caption":"Foreign eligible","value":"',
                 CASE p_partkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'NO' ELSE 'unknown' END,
                 '"},{"tag":"y","caption":"Foreign eligible","value":"no"}]}]}') AS payload
        FROM part""",
    "item_pages": """
        SELECT p_partkey % 50 AS page_no,
               concat('{"total":', CAST(count(*) * 37 AS STRING), ',"items":[{"id":', CAST(min(p_partkey) AS STRING),
                      ',"name":"a"},{"id":', CAST(max(p_partkey) AS STRING), ',"name":"b"}]}') AS payload
        FROM part GROUP BY 1""",
    "catalogue_json": """
        SELECT s_suppkey AS dataset_id,
               concat('{"result":{"resources":[{"format":"PDF","url":"u', CAST(s_suppkey AS STRING), '.pdf"}',
                      CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE concat(',{"format":"',
                        CASE WHEN s_suppkey % 2 = 0 THEN 'CSV' ELSE 'csv' END, '","url":"u', CAST(s_suppkey AS STRING),
                        '.csv"},{"format":"CSV","url":"late.csv"}') END, ']}}') AS payload
        FROM supplier""",
}

_REFERENCE = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_]+)")


def _used(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_REFERENCE.findall(sql)) if n in DATASETS]


def _closure(names: list[str]) -> list[str]:
    """The datasets needed by `names`, each after those it reads."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for dep in _used(DATASETS[name]):
            visit(dep)
        done.append(name)

    for n in names:
        visit(n)
    return done


def with_clause(sql: str) -> str:
    """CTE definitions for every dataset that `sql` mentions."""
    return ", ".join(f"{n} AS ({DATASETS[n].strip()})" for n in _closure(_used(sql)))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or derived dataset as a lazy DataFrame."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in DATASETS:
        raise AttributeError(f"no table or dataset named {name}")
    ctes = ", ".join(
        f"{n} AS ({_on_files(DATASETS[n], sf_dir).strip()})" for n in _closure([name])
    )
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}")


def _on_files(sql: str, sf_dir: str) -> str:
    def swap(match: re.Match) -> str:
        keyword, table = match.group(1), match.group(2)
        if table in BASE_TABLES:
            return f"{keyword} parquet.`{sf_dir}/{table}.parquet` AS {table}"
        return match.group(0)

    return re.sub(r"\b(FROM|JOIN)\s+([a-z_]+)\b(?!\s+AS\b)", swap, sql)
