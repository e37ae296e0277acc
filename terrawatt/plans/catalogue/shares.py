"""Marts: shares, top-k, histograms, KPIs. One entry per data layer."""

from pyspark.sql import functions as F

from terrawatt.operators import aggregates as agg
from terrawatt.operators import windows as win
from terrawatt.plans import marts
from terrawatt.plans.catalogue.metering import REPORT, clean
from terrawatt.plans.datasets import AS_OF_SALES
from terrawatt.plans.registry import query

AGE_AS_OF = "2025-06-30"


def share_sql(source: str, by: str, measures: dict[str, str], share_of: str) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in measures.items())
    total = measures[share_of]
    return f"SELECT {by}, {cols}, CAST({total} AS DOUBLE) / sum({total}) OVER () AS percentage FROM {source} GROUP BY {by}"


AREA = {"area_m2": "sum(total_area_km2 * 1e6)"}
MARKET_SHARE = share_sql("developer", "developer_name", {"area_m2": "sum(total_development_area_m2)"}, "area_m2")
AREA_SHARE = share_sql("zone", "type", AREA, "area_m2")
SALE_USAGE = share_sql("sale", "usage_type", {
    "transactions_count": "count(*)", "total_sale_volume": "sum(price_aed)", "total_area_m2": "sum(area_m2)"}, "total_area_m2")
LEASE_MEASURES = {"contracts_count": "count(*)", "total_area_m2": "sum(area_m2)"}
LEASE_CONTRACT = share_sql("lease", "contract_type", LEASE_MEASURES, "total_area_m2")
LEASE_TENANT = share_sql("lease", "tenant_type", LEASE_MEASURES, "total_area_m2")
POI_SHARE = share_sql("poi", "category", {"total_footfall": "sum(avg_weekday_footfall + avg_weekend_footfall)"}, "total_footfall")
CARGO_SHARE = share_sql("logistics", "cargo_type", {"total_throughput_mt": "sum(annual_throughput_mt)"}, "total_throughput_mt")
COMPANY_SHARE = share_sql("company", "business_type", {"companies_count": "count(*)"}, "companies_count")
LISTING_SHARE = share_sql("supply", "listing_type", {"listings_count": "count(*)", "total_area_m2": "CAST(sum(total_area_m2) AS BIGINT)"}, "total_area_m2")
AGE = f"""CASE WHEN year(DATE '{AGE_AS_OF}') - completion_year <= 5 THEN 'New (0-5 years)'
    WHEN year(DATE '{AGE_AS_OF}') - completion_year <= 15 THEN 'Modern (5-15 years)' ELSE 'Mature (15+ years)' END"""
AGE_SHARE = f"""SELECT age_group, count(*) AS buildings_count, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS percentage
    FROM (SELECT {AGE} AS age_group FROM building) GROUP BY age_group"""


def share(name, sql, build, rounds):
    query(f"win_share_of_total{name}", sql, rounds + " percentage")(build)


share("", MARKET_SHARE, lambda t: marts.developer_market_share(t.developer), "area_m2")
for _name, _type in (("ownership", "ownership_types"), ("land_use", "permitted_usage"), ("economic_zone", "zone_type")):
    share(f"__{_name}", AREA_SHARE, lambda t: marts.area_distribution(t.zone, "type"), "area_m2")
share("__sale_usage", SALE_USAGE, lambda t: marts.sale_usage_distribution(t.sale), "total_sale_volume:2 total_area_m2")
share("__lease_contract", LEASE_CONTRACT, lambda t: marts.lease_distribution(t.lease, "contract_type"), "total_area_m2")
share("__lease_tenant", LEASE_TENANT, lambda t: marts.lease_distribution(t.lease, "tenant_type"), "total_area_m2")
share("__poi_category", POI_SHARE, lambda t: marts.poi_category_distribution(t.poi), "total_footfall")
share("__cargo", CARGO_SHARE, lambda t: marts.logistics_type_distribution(t.logistics), "total_throughput_mt")
share("__company_type", COMPANY_SHARE, lambda t: marts.company_type_distribution(t.company), "")
share("__building_age", AGE_SHARE, lambda t: marts.building_age_profile(t.building, AGE_AS_OF), "")
share("__listing_type", LISTING_SHARE, lambda t: marts.supply_listing_type(t.supply), "")


@query("agg_case_group", AGE_SHARE, "percentage")
def _(t):
    return marts.building_age_profile(t.building, AGE_AS_OF)


@query("win_share_of_partition", """SELECT plan_id, usage_name, area_m2, area_m2 / sum(area_m2) OVER (PARTITION BY plan_id) AS percentage
    FROM plan_usage""", "area_m2 percentage")
def _(t):
    return marts.plan_usage_mix(t.plan_usage)


COMPLETION = """SELECT developer_id, status, area_m2, area_m2 / sum(area_m2) OVER (PARTITION BY developer_id) AS percentage
    FROM completion_status"""


@query("win_share_of_partition__completion", COMPLETION, "area_m2 percentage")
def _(t):
    return marts.developer_completion(t.completion_status)


# --- top k ------------------------------------------------------------------------------

AREA_TOP = "SELECT id, total_area_km2 FROM zone ORDER BY total_area_km2 DESC NULLS FIRST, id LIMIT 3"


@query("topk_simple", "SELECT plan_id, area_km2 FROM plan_geom ORDER BY area_km2 DESC NULLS FIRST, plan_id LIMIT 3", "area_km2")
def _(t):
    return win.topk_simple(t.plan_geom, "area_km2", "plan_id")


for _name in ("ownership", "land_use", "economic_zone"):
    query(f"topk_simple__{_name}", AREA_TOP, "total_area_km2")(lambda t: marts.area_top3(t.zone, "id"))

POI_TOP = """SELECT poi_id, avg_weekday_footfall + avg_weekend_footfall AS combined_footfall FROM poi
    ORDER BY combined_footfall DESC NULLS FIRST, poi_id LIMIT 3"""
HUB_TOP = "SELECT logistics_id, annual_throughput_mt FROM logistics ORDER BY annual_throughput_mt DESC NULLS FIRST, logistics_id LIMIT 3"
PREMISE_TOP = """SELECT premise_type, sum(area_m2) / 1e6 AS total_area_km2 FROM lease GROUP BY premise_type
    ORDER BY total_area_km2 DESC NULLS FIRST, premise_type LIMIT 3"""
CARGO_TOP = """SELECT cargo_type, sum(annual_throughput_mt) AS total_throughput_mt FROM logistics GROUP BY cargo_type
    ORDER BY total_throughput_mt DESC NULLS FIRST, cargo_type LIMIT 3"""
COMPANY_TOP = """SELECT business_type, count(*) AS companies_count FROM company GROUP BY business_type
    ORDER BY companies_count DESC, business_type LIMIT 3"""
SUBTYPE_TOP = """SELECT subtype, count(*) AS listings_count FROM supply GROUP BY subtype ORDER BY listings_count DESC, subtype LIMIT 3"""

query("topk_simple__poi", POI_TOP, "combined_footfall")(lambda t: marts.poi_top_locations(t.poi))
query("topk_simple__hubs", HUB_TOP, "annual_throughput_mt")(lambda t: marts.logistics_top_hubs(t.logistics))
query("topk_after_group", PREMISE_TOP, "total_area_km2")(lambda t: marts.lease_top_property_types(t.lease))
query("topk_after_group__cargo", CARGO_TOP, "total_throughput_mt")(lambda t: marts.logistics_top_types(t.logistics))
query("topk_after_group__company_type", COMPANY_TOP)(lambda t: marts.company_top_types(t.company))
query("topk_after_group__subtype", SUBTYPE_TOP)(lambda t: marts.supply_top_subtypes(t.supply))


@query("topk_recent", "SELECT event_id, meter_id, timestamp FROM meter_readings ORDER BY timestamp DESC, event_id LIMIT 20")
def _(t):
    return win.topk_recent(t.meter_readings.select("event_id", "meter_id", "timestamp"), "timestamp", 20, ["event_id"])


@query("topk_recent__daily", f"SELECT * FROM ({REPORT}) ORDER BY date DESC, meter_id LIMIT 10", "total_energy avg_voltage avg_current max_consumption")
def _(t):
    return win.topk_recent(agg.agg_daily_energy_report(clean(t)), "date", 10, ["meter_id"])


@query("top_frequent_values", """SELECT meter_id AS value, count(*) AS count FROM meter_readings GROUP BY 1
    ORDER BY count DESC, value NULLS FIRST LIMIT 10""")
def _(t):
    return win.top_frequent_values(t.meter_readings, "meter_id")


@query("win_latest_per_key", """SELECT meter_id, last_seen, signal_strength, online FROM (SELECT *, row_number() OVER
    (PARTITION BY meter_id ORDER BY last_seen DESC, status_id DESC) AS rn FROM meter_status) WHERE rn = 1""")
def _(t):
    return win.win_latest_per_key(t.meter_status, "meter_id", "last_seen", "status_id").drop("status_id")


@query("win_row_number_random", """SELECT event_id, row_number() OVER (ORDER BY md5(concat(CAST(event_id AS VARCHAR), '#7')), event_id) AS rn
    FROM events QUALIFY rn <= 25""")
def _(t):
    return win.win_row_number_random(t.events.select("event_id"), "event_id", 25, seed=7)


@query("sort_global", "SELECT orders.o_orderkey, orders.o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def _(t):
    return win.sort_global(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


# --- histograms, KPIs, counts -----------------------------------------------------------

def bucket_sql(source: str, col: str, lo: int, hi: int, n: int, bucket: str, count: str) -> str:
    width = (hi - lo) / n
    return f"""SELECT CASE WHEN {col} IS NULL THEN NULL WHEN {col} < {lo} THEN 0 WHEN {col} >= {hi} THEN {n + 1}
        ELSE CAST(floor(({col} - {lo}) / {width}) AS BIGINT) + 1 END AS {bucket}, count(*) AS {count},
        min({col}) AS bucket_min, max({col}) AS bucket_max FROM {source} GROUP BY 1"""


@query("agg_histogram_width_bucket", bucket_sql("sale", "price_aed", 0, 100_000, 50, "bucket", "transactions_count"), "bucket_min bucket_max")
def _(t):
    return marts.sale_price_distribution(t.sale, "price_aed")


SIZES = bucket_sql("company", "headcount", 0, 1000, 10, "headcount_bucket", "companies_count")


@query("agg_histogram_width_bucket__headcount", SIZES)
def _(t):
    return marts.company_size_distribution(t.company)


def kpi(name, sql, build, rounds=""):
    query(f"agg_kpi_global{name}", sql, rounds)(build)


LEASE_KPI = """SELECT count(*) AS total_contracts, sum(total_rent_aed) AS total_rental_value_aed,
    sum(area_m2) / 1e6 AS total_area_km2, avg(rent_per_m2) AS avg_rent_per_m2 FROM lease"""
kpi("", """SELECT count(*) AS total_transactions, sum(price_aed) AS total_sale_volume_aed, sum(area_m2) / 1e6 AS total_area_km2,
    avg(price_per_m2) AS avg_price_per_m2 FROM sale""", lambda t: marts.sale_kpis(t.sale),
    "total_sale_volume_aed:2 total_area_km2 avg_price_per_m2")
kpi("__lease", LEASE_KPI, lambda t: marts.lease_kpis(t.lease), "total_rental_value_aed:1 total_area_km2 avg_rent_per_m2")
kpi("__population", """SELECT count(*) AS total_areas, CAST(sum(total_population) AS BIGINT) AS total_population,
    CAST(sum(residents) AS BIGINT) AS total_residents, CAST(sum(workforce) AS BIGINT) AS total_workforce FROM population""",
    lambda t: marts.population_kpis(t.population))
kpi("__poi", """SELECT count(*) AS total_pois, avg(avg_weekday_footfall) AS avg_weekday_footfall,
    avg(avg_weekend_footfall) AS avg_weekend_footfall FROM poi""", lambda t: marts.poi_kpis(t.poi), "avg_weekday_footfall avg_weekend_footfall")
kpi("__company", """SELECT count(*) AS total_companies, avg(headcount) AS avg_headcount, avg(customer_rating) AS avg_customer_rating
    FROM company""", lambda t: marts.company_kpis(t.company), "avg_headcount avg_customer_rating")
kpi("__building", """SELECT count(*) AS total_buildings, sum(floor_area_m2) AS total_floor_area_m2,
    CAST(sum(properties_count) AS BIGINT) AS total_properties_count, avg(completion_year) AS avg_completion_year FROM building""",
    lambda t: marts.building_kpis(t.building), "total_floor_area_m2 avg_completion_year")
kpi("__supply", """SELECT count(*) AS total_listings, avg(price_per_m2) AS avg_price_per_m2,
    CAST(sum(total_area_m2) AS BIGINT) AS total_listed_area_m2, avg(estimated_cap_rate) AS avg_cap_rate FROM supply""",
    lambda t: marts.supply_kpis(t.supply), "avg_price_per_m2 avg_cap_rate")
kpi("__plot_count", "SELECT count(*) AS total_plots FROM plot",
    lambda t: agg.agg_kpi_global(t.plot, {"total_plots": F.count(F.lit(1))}))

YEAR_STATS = f"""SELECT community_id, sum(price_aed) AS transactions_volume_1y, count(*) AS transactions_count_1y FROM sale
    WHERE transaction_date >= DATE '{AS_OF_SALES}' - INTERVAL 1 YEAR GROUP BY community_id"""


@query("agg_one_year_volume", YEAR_STATS, "transactions_volume_1y:2")
def _(t):
    return agg.agg_one_year_volume(t.sale, AS_OF_SALES)


@query("agg_price_per_area", f"""SELECT community_id, property_type, count(*) AS transactions_count,
    avg(price_aed / nullif(area_m2, 0)) AS avg_price_per_m2 FROM sale
    WHERE transaction_date >= DATE '{AS_OF_SALES}' - INTERVAL 1 YEAR GROUP BY community_id, property_type""", "avg_price_per_m2")
def _(t):
    return agg.agg_price_per_area(t.sale, AS_OF_SALES)


@query("agg_count_by_key", "SELECT community_id, count(*) AS district_count FROM district GROUP BY community_id")
def _(t):
    return agg.agg_count_by_key(t.district, "community_id", "district_count")


@query("agg_count_by_key__building_status", "SELECT construction_status, count(*) AS buildings_count FROM building GROUP BY 1")
def _(t):
    return marts.building_status_distribution(t.building)
