"""Flattened read models of the data layers.

The oracles state what each column means over the base rows: shares and counts as windows over a row's
own group, looked-up values as scalar subqueries, top ranks as a condition on a row's group.
"""

from terrawatt.operators import aggregates as agg
from terrawatt.plans import marts
from terrawatt.plans.catalogue import shares as s
from terrawatt.plans.datasets import AS_OF_SALES
from terrawatt.plans.registry import query


def group_columns(key: str, columns: dict[str, str]) -> str:
    """Measures of the group that a row belongs to; a row without a group has none."""
    return ", ".join(f"CASE WHEN {key} IS NOT NULL THEN {e} END AS {n}" for n, e in columns.items())


def of_group(measure: str, key: str) -> str:
    return f"{measure} OVER (PARTITION BY {key})"


def share_of_all(measure: str, key: str) -> str:
    return f"CAST({of_group(measure, key)} AS DOUBLE) / {measure} OVER ()"


def top_groups(source: str, key: str, measure: str, columns: dict[str, str], k: int = 3) -> str:
    """`columns` where a row's group is among the k largest by `measure`, else NULL."""
    best = f"(SELECT {key} FROM {source} GROUP BY {key} QUALIFY row_number() OVER (ORDER BY {measure} DESC NULLS FIRST, {key}) <= {k})"
    return ", ".join(f"CASE WHEN {key} IN {best} THEN {e} END AS {n}" for n, e in columns.items())


def looked_up(column: str, table: str, key: str, row: str) -> str:
    return f"(SELECT any_value({table}.{column}) FROM {table} WHERE {table}.{key} = {row}.{key}) AS {column}"


def located(row: str, key: str, table: str) -> str:
    return ", ".join(looked_up(c, table, key, row) for c in ("lon", "lat"))


YEAR = f"community_id = community.community_id AND transaction_date >= DATE '{AS_OF_SALES}' - INTERVAL 1 YEAR"


@query("v_admin_divisions", "SELECT " + ", ".join([
    looked_up("emirate_id", "city", "city_id", "community"),
    "(SELECT any_value(emirate_name) FROM emirate WHERE emirate_id IN (SELECT emirate_id FROM city WHERE city_id = community.city_id)) AS emirate_name",
    "city_id", looked_up("city_name", "city", "city_id", "community"),
    looked_up("sector_id", "sector", "sector_id", "community"), looked_up("sector_name", "sector", "sector_id", "community"),
    "community_id", "community_name",
    *[looked_up(c, table, "community_id", "community") for table, columns in (
        ("community_geom", ("area_km2",)), ("community_population", ("total_population", "density")),
        ("active_companies", ("active_companies",)), ("community_supply", ("total_supply_m2",))) for c in columns],
    f"(SELECT sum(price_aed) FROM sale WHERE {YEAR}) AS transactions_volume_1y",
    f"(SELECT nullif(count(*), 0) FROM sale WHERE {YEAR}) AS transactions_count_1y",
    "(SELECT nullif(count(*), 0) FROM district WHERE district.community_id = community.community_id) AS district_count",
]) + """ FROM community WHERE EXISTS (SELECT 1 FROM city WHERE city.city_id = community.city_id
    AND EXISTS (SELECT 1 FROM emirate WHERE emirate.emirate_id = city.emirate_id))""",
       "area_km2 density total_supply_m2 transactions_volume_1y:2")
def _(t):
    return marts.v_admin_divisions(
        t.emirate, t.city, t.sector, t.community, t.community_geom, t.community_population, t.active_companies,
        t.community_supply, agg.agg_one_year_volume(t.sale, AS_OF_SALES), t.district,
    )


@query("v_development_plans", """WITH shares AS (SELECT plan_id, list({'land_use_category': usage_name, 'land_use_area_m2': area_m2, 'land_use_percentage': part}) AS uses
    FROM (SELECT *, area_m2 / sum(area_m2) OVER (PARTITION BY plan_id) AS part FROM plan_usage) GROUP BY plan_id),
    mapped AS (SELECT *, (SELECT any_value(area_km2) FROM plan_geom WHERE plan_geom.plan_id = development_plan.plan_id) AS total_zone_area_km2,
    unnest(coalesce((SELECT any_value(uses) FROM shares WHERE shares.plan_id = development_plan.plan_id), [NULL])) AS kind
    FROM development_plan WHERE plan_id IN (SELECT plan_id FROM plan_geom))
    SELECT * EXCLUDE (kind), kind.land_use_category, kind.land_use_area_m2, kind.land_use_percentage FROM mapped""",
       "total_zone_area_km2 land_use_area_m2 land_use_percentage")
def _(t):
    return marts.v_development_plans(t.development_plan, t.plan_geom, t.plan_usage)


@query("v_master_developers", f"""WITH held AS (SELECT *, sum(total_development_area_m2) OVER (PARTITION BY developer_name) AS of_name,
    sum(total_development_area_m2) OVER () AS of_all FROM developer),
    stages AS (SELECT *, sum(area_m2) OVER (PARTITION BY developer_id) AS of_developer FROM completion_status)
    SELECT held.* EXCLUDE (of_name, of_all), (SELECT any_value(area_m2) FROM developer_geom WHERE developer_geom.developer_id = held.developer_id) AS zone_polygon_area_m2,
    {group_columns('developer_name', {'developer_market_area_m2': 'of_name', 'developer_market_share': 'CAST(of_name AS DOUBLE) / of_all'})},
    stages.status AS completion_status, stages.area_m2 AS completion_area_m2, stages.area_m2 / of_developer AS completion_percentage
    FROM held LEFT JOIN stages USING (developer_id) WHERE developer_id IN (SELECT developer_id FROM developer_geom)""",
       "total_development_area_m2 zone_polygon_area_m2 developer_market_area_m2 developer_market_share completion_area_m2 completion_percentage")
def _(t):
    return marts.v_master_developers(t.developer, t.developer_geom, t.completion_status)


@query("v_cadastral_maps", """SELECT *, (SELECT any_value(area_m2) FROM plot_geom WHERE plot_geom.plot_id = counted.plot_id) AS plot_polygon_area_m2
    FROM (SELECT *, count(*) OVER () AS total_cadastral_samples FROM plot) AS counted WHERE plot_id IN (SELECT plot_id FROM plot_geom)""", "land_area_m2 plot_polygon_area_m2")
def _(t):
    return marts.v_cadastral_maps(t.plot, t.plot_geom)


def _area_sql(share: tuple[str, str], top: tuple[str, str]) -> str:
    return f"""SELECT z.*, g.area_km2 AS polygon_area_km2, d.area_m2 AS {share[0]}, d.percentage AS {share[1]},
        x.id AS {top[0]}, x.total_area_km2 AS {top[1]} FROM zone AS z JOIN zone_geom AS g ON g.id = z.id
        LEFT JOIN ({s.AREA_SHARE}) AS d ON d.type = z.type LEFT JOIN ({s.AREA_TOP}) AS x ON x.id = z.id"""


def _area(name, build, share, top):
    query(name, _area_sql(share, top), f"total_area_km2 polygon_area_km2 {share[0]} {share[1]} {top[1]}")(
        lambda t: build(t.zone, t.zone_geom, "id", "type")
    )


_area("v_ownership_types", marts.v_ownership_types, ("ownership_area_m2", "ownership_percentage"), ("top_ownership_id", "top_ownership_area_km2"))
_area("v_land_use", marts.v_land_use, ("usage_area_m2", "usage_percentage"), ("top_use_id", "top_use_area_km2"))
_area("v_economic_zones", marts.v_economic_zones, ("zone_type_area_m2", "zone_type_percentage"), ("top_zone_id", "top_zone_area_km2"))


@query("v_sale_transactions", f"""SELECT * EXCLUDE (community_id), {located('sale', 'sale_id', 'sale_geom')}, {group_columns('usage_type', {
    'usage_transactions': of_group('count(*)', 'usage_type'), 'usage_area_m2': of_group('sum(area_m2)', 'usage_type'),
    'usage_percentage': share_of_all('sum(area_m2)', 'usage_type')})} FROM sale""", "usage_area_m2 usage_percentage")
def _(t):
    return marts.v_sale_transactions(t.sale, t.sale_geom)


def _lease_group(key: str, label: str, count: str, area: str, share: str) -> str:
    return group_columns(key, {
        label: key, count: of_group("count(*)", key), area: of_group("sum(area_m2)", key), share: share_of_all("sum(area_m2)", key),
    })


@query("v_lease_transactions", "SELECT *, " + ", ".join([
    located("lease", "lease_id", "lease_geom"), "count(*) OVER () AS total_contracts", "sum(total_rent_aed) OVER () AS total_rental_value_aed",
    "sum(area_m2) OVER () / 1e6 AS total_area_km2", "avg(rent_per_m2) OVER () AS avg_rent_per_m2",
    _lease_group("contract_type", "dist_contract_type", "dist_contracts_count", "dist_contract_area_m2", "dist_contract_percentage"),
    _lease_group("tenant_type", "dist_tenant_type", "dist_tenant_count", "dist_tenant_area_m2", "dist_tenant_percentage"),
    top_groups("lease", "premise_type", "sum(area_m2)", {
        "top_premise_type": "premise_type", "top_premise_area_km2": of_group("sum(area_m2)", "premise_type") + " / 1e6"}),
]) + " FROM lease",
       "total_rental_value_aed:1 total_area_km2 avg_rent_per_m2 "
       "dist_contract_area_m2 dist_contract_percentage dist_tenant_area_m2 dist_tenant_percentage top_premise_area_km2")
def _(t):
    return marts.v_lease_transactions(t.lease, t.lease_geom, *marts.lease_marts(t.lease))


def _of_each(table: str, label: str, of: str, name: str) -> str:
    """The groups of one kind that belong to a row of `of`, one row for each (or one without group)."""
    return f"""unnest(coalesce((SELECT list({{'label': {label}, 'people': people_count}}) FROM {table}
        WHERE {table}.population_id = {of}.population_id), [NULL])) AS {name}"""


# Every combination of a population's groups: one kind is unfolded after the other.
@query("v_population", f"""WITH nations AS (SELECT *, {_of_each('demographics', 'nationality_group', 'population', 'nation')} FROM population WHERE population_id IN (SELECT population_id FROM population_geom)),
    aged AS (SELECT *, {_of_each('age_distribution', 'age_group', 'nations', 'age')} FROM nations),
    every AS (SELECT *, {_of_each('gender_split', 'gender', 'aged', 'sex')} FROM aged)
    SELECT * EXCLUDE (nation, age, sex), (SELECT any_value(area_km2) FROM population_geom WHERE population_geom.population_id = every.population_id) AS polygon_area_km2,
    nation.label AS nationality_group, nation.people AS nationality_people, age.label AS age_group, age.people AS age_people, sex.label AS gender, sex.people AS gender_people
    FROM every""", "polygon_area_km2")
def _(t):
    return marts.v_population(t.population, t.population_geom, t.demographics, t.age_distribution, t.gender_split)


FOOTFALL = "sum(avg_weekday_footfall + avg_weekend_footfall)"


@query("v_points_of_interests", "SELECT *, " + ", ".join([
    located("poi", "poi_id", "poi_geom"),
    group_columns("category", {
        "dist_category": "category", "dist_category_footfall": of_group(FOOTFALL, "category"), "dist_category_percentage": share_of_all(FOOTFALL, "category")}),
    top_groups("poi", "poi_id", FOOTFALL, {"top_poi_id": "poi_id", "top_poi_combined_footfall": of_group(FOOTFALL, "poi_id")}),
]) + " FROM poi",
       "avg_weekday_footfall avg_weekend_footfall lon lat dist_category_footfall dist_category_percentage top_poi_combined_footfall")
def _(t):
    return marts.v_points_of_interests(t.poi, t.poi_geom)


THROUGHPUT = "sum(annual_throughput_mt)"
PLACE = "(SELECT any_value({0}) FROM poi_geom WHERE poi_id = logistics.logistics_id) AS {0}"


@query("v_freight_logistics", "SELECT *, " + ", ".join([
    PLACE.format("lon"), PLACE.format("lat"),
    group_columns("cargo_type", {
        "dist_cargo_type": "cargo_type", "dist_cargo_throughput": of_group(THROUGHPUT, "cargo_type"), "dist_cargo_percentage": share_of_all(THROUGHPUT, "cargo_type")}),
    top_groups("logistics", "logistics_id", THROUGHPUT, {"top_hub_id": "logistics_id", "top_hub_throughput": "annual_throughput_mt"}),
    top_groups("logistics", "cargo_type", THROUGHPUT, {"top_type": "cargo_type", "top_type_throughput": of_group(THROUGHPUT, "cargo_type")}),
]) + " FROM logistics",
       "annual_throughput_mt lon lat dist_cargo_throughput dist_cargo_percentage top_hub_throughput top_type_throughput")
def _(t):
    return marts.v_freight_logistics(t.logistics, t.poi_geom.withColumnRenamed("poi_id", "logistics_id"))


AT = "(SELECT any_value({0}) FROM points WHERE id = company.company_id AND id % 4 <> 0) AS {0}"


# Every company meets every size class; the classes are those of the headcount histogram.
@query("v_companies", "SELECT each_company.*, sizes.headcount_bucket, sizes.bucket_min, sizes.bucket_max, sizes.companies_count AS size_bucket_count FROM (SELECT * EXCLUDE (community_id), " + ", ".join([
    AT.format("lon"), AT.format("lat"),
    group_columns("business_type", {
        "dist_business_type": "business_type", "dist_business_count": of_group("count(*)", "business_type"), "dist_business_percentage": share_of_all("count(*)", "business_type")}),
    top_groups("company", "business_type", "count(*)", {"top_business_type": "business_type", "top_business_count": of_group("count(*)", "business_type")}),
]) + f" FROM company) AS each_company LEFT JOIN ({s.SIZES}) AS sizes ON TRUE", "lon lat dist_business_percentage")
def _(t):
    geom = t.points.where("id % 4 <> 0").withColumnRenamed("id", "company_id")
    return marts.v_companies(t.company, geom)


@query("v_buildings", f"""SELECT *, (SELECT any_value(area_km2) FROM zone_geom WHERE zone_geom.id = building.building_id) AS polygon_area_km2, {s.AGE} AS age_group
    FROM building""", "floor_area_m2 polygon_area_km2")
def _(t):
    return marts.v_buildings(t.building, t.zone_geom.withColumnRenamed("id", "building_id"), s.AGE_AS_OF)


@query("v_real_estate_supply", "SELECT *, " + ", ".join([
    located("supply", "supply_id", "supply_geom"),
    group_columns("listing_type", {
        "dist_listing_type": "listing_type", "dist_listing_count": of_group("count(*)", "listing_type"),
        "dist_listing_area_m2": f"CAST({of_group('sum(total_area_m2)', 'listing_type')} AS BIGINT)", "dist_listing_percentage": share_of_all("sum(total_area_m2)", "listing_type")}),
    top_groups("supply", "subtype", "count(*)", {"top_subtype": "subtype", "top_subtype_count": of_group("count(*)", "subtype")}),
]) + " FROM supply", "price_per_m2 estimated_cap_rate lon lat dist_listing_percentage")
def _(t):
    return marts.v_real_estate_supply(t.supply, t.supply_geom)
