"""Real-estate marts: the materialised views of each data layer and its flattened read model.

A flattened model passes the descriptive columns through, hides the administrative anchors and
adds geometry and mart columns. All are built from the generic shapes in `operators.windows`,
`operators.aggregates` and `operators.joins`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.operators import aggregates as agg
from terrawatt.operators import windows as win
from terrawatt.operators.joins import join_multi_child_fanout, join_on_true_fanout, join_on_true_scalar
from terrawatt.session import scratch_path

ADMIN_ANCHORS = ("emirate_id", "city_id", "sector_id", "community_id", "district_id")

# Histogram bounds and age limits of the marts.
PRICE_BUCKETS = (0, 100_000, 50)
HEADCOUNT_BUCKETS = (0, 1000, 10)
AGE_GROUPS = ((5, "New (0-5 years)"), (15, "Modern (5-15 years)"))
OLDEST_GROUP = "Mature (15+ years)"

def flatten(base: DataFrame, *joins: tuple[DataFrame, str, Mapping[str, str], str]) -> DataFrame:
    """Base columns without anchors, plus renamed columns of each join (frame, key, names, how)."""
    shown = [c for c in base.columns if c not in ADMIN_ANCHORS]
    out, extra = base, []
    for frame, key, names, how in joins:
        side = frame.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_x_{a}") for c, a in names.items()])
        out = out.join(side, out[key] == side["_k"], how).drop("_k")
        extra += [F.col(f"_x_{a}").alias(a) for a in names.values()]
    return out.select(*shown, *extra)


def _geom(geom: DataFrame, key: str, area: str | None = None, area_as: str | None = None) -> tuple:
    names = {c: c for c in geom.columns if c not in (key, area)}
    if area and area in geom.columns:
        names[area] = area_as
    return geom, key, names


# --- administrative divisions -----------------------------------------------------------


def v_admin_divisions(
    emirate: DataFrame, city: DataFrame, sector: DataFrame, community: DataFrame, geom: DataFrame,
    population: DataFrame, companies: DataFrame, supply: DataFrame, year_stats: DataFrame, districts: DataFrame,
) -> DataFrame:
    counts = agg.agg_count_by_key(districts, "community_id", "district_count")
    # An unknown sector shows as NULL, so its id is taken from the sector side.
    named = sector.select(F.col("sector_id").alias("_sector"), "sector_id", "sector_name")
    out = community.withColumnRenamed("sector_id", "_sector").join(city, "city_id").join(emirate, "emirate_id")
    out = out.join(named, "_sector", "left")
    for side in (geom, population, companies, supply, year_stats, counts):
        out = out.join(side, "community_id", "left")
    return out.select(
        "emirate_id", "emirate_name", "city_id", "city_name", "sector_id", "sector_name",
        "community_id", "community_name", "area_km2", "total_population", "density", "active_companies",
        "total_supply_m2", "transactions_volume_1y", "transactions_count_1y", "district_count",
    )


# --- plans and developers ---------------------------------------------------------------


def plan_usage_mix(usage: DataFrame) -> DataFrame:
    return win.win_share_of_partition(usage, "area_m2", "plan_id")


def v_development_plans(plan: DataFrame, geom: DataFrame, usage: DataFrame) -> DataFrame:
    mix = plan_usage_mix(usage)
    names = {"usage_name": "land_use_category", "area_m2": "land_use_area_m2", "percentage": "land_use_percentage"}
    return flatten(
        plan, (*_geom(geom, "plan_id", "area_km2", "total_zone_area_km2"), "inner"), (mix, "plan_id", names, "left")
    )


def developer_market_share(developer: DataFrame) -> DataFrame:
    return win.win_share_of_total(
        developer, "developer_name", {"area_m2": F.sum("total_development_area_m2")}, "area_m2"
    )


def developer_completion(status: DataFrame) -> DataFrame:
    return win.win_share_of_partition(status, "area_m2", "developer_id")


def v_master_developers(developer: DataFrame, geom: DataFrame, status: DataFrame) -> DataFrame:
    share, done = developer_market_share(developer), developer_completion(status)
    return flatten(
        developer,
        (*_geom(geom, "developer_id", "area_m2", "zone_polygon_area_m2"), "inner"),
        (share, "developer_name", {"area_m2": "developer_market_area_m2", "percentage": "developer_market_share"}, "left"),
        (done, "developer_id", {"status": "completion_status", "area_m2": "completion_area_m2", "percentage": "completion_percentage"}, "left"),
    )


def v_cadastral_maps(plot: DataFrame, geom: DataFrame) -> DataFrame:
    total = agg.agg_kpi_global(plot, {"total_cadastral_samples": F.count(F.lit(1))})
    return join_on_true_scalar(flatten(plot, (*_geom(geom, "plot_id", "area_m2", "plot_polygon_area_m2"), "inner")), total)


# --- ownership, land use, economic zones ------------------------------------------------


def area_distribution(df: DataFrame, kind: str) -> DataFrame:
    return win.win_share_of_total(df, kind, {"area_m2": F.sum(F.col("total_area_km2") * 1e6)}, "area_m2")


def area_top3(df: DataFrame, key: str) -> DataFrame:
    return win.topk_simple(df.select(key, "total_area_km2"), "total_area_km2", key)


def _area_view(df: DataFrame, geom: DataFrame, key: str, kind: str, share: tuple[str, str], top: tuple[str, str]) -> DataFrame:
    best = area_top3(df, key).withColumn("_id", F.col(key))
    return flatten(
        df,
        (*_geom(geom, key, "area_km2", "polygon_area_km2"), "inner"),
        (area_distribution(df, kind), kind, {"area_m2": share[0], "percentage": share[1]}, "left"),
        (best, key, {"_id": top[0], "total_area_km2": top[1]}, "left"),
    )


def v_ownership_types(ownership: DataFrame, geom: DataFrame, key: str = "ownership_id", kind: str = "ownership_types") -> DataFrame:
    return _area_view(ownership, geom, key, kind, ("ownership_area_m2", "ownership_percentage"), ("top_ownership_id", "top_ownership_area_km2"))


def v_land_use(use: DataFrame, geom: DataFrame, key: str = "use_id", kind: str = "permitted_usage") -> DataFrame:
    return _area_view(use, geom, key, kind, ("usage_area_m2", "usage_percentage"), ("top_use_id", "top_use_area_km2"))


def v_economic_zones(zone: DataFrame, geom: DataFrame, key: str = "zone_id", kind: str = "zone_type") -> DataFrame:
    return _area_view(zone, geom, key, kind, ("zone_type_area_m2", "zone_type_percentage"), ("top_zone_id", "top_zone_area_km2"))


# --- transactions -----------------------------------------------------------------------


def sale_kpis(sale: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(sale, {
        "total_transactions": F.count(F.lit(1)), "total_sale_volume_aed": F.sum("price_aed"),
        "total_area_km2": F.sum("area_m2") / 1e6, "avg_price_per_m2": F.avg("price_per_m2"),
    })


def sale_price_distribution(sale: DataFrame, col: str = "price_per_m2") -> DataFrame:
    return agg.agg_histogram_width_bucket(sale, col, *PRICE_BUCKETS, count_name="transactions_count")


def sale_usage_distribution(sale: DataFrame) -> DataFrame:
    return win.win_share_of_total(sale, "usage_type", {
        "transactions_count": F.count(F.lit(1)), "total_sale_volume": F.sum("price_aed"), "total_area_m2": F.sum("area_m2"),
    }, "total_area_m2")


def v_sale_transactions(sale: DataFrame, geom: DataFrame, usage: DataFrame | None = None) -> DataFrame:
    """`usage` is the stored usage mart; without it the mart is computed from the sales again."""
    usage = sale_usage_distribution(sale) if usage is None else usage
    names = {"transactions_count": "usage_transactions", "total_area_m2": "usage_area_m2", "percentage": "usage_percentage"}
    return flatten(sale, (*_geom(geom, "sale_id"), "left"), (usage, "usage_type", names, "left"))


def lease_kpis(lease: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(lease, {
        "total_contracts": F.count(F.lit(1)), "total_rental_value_aed": F.sum("total_rent_aed"),
        "total_area_km2": F.sum("area_m2") / 1e6, "avg_rent_per_m2": F.avg("rent_per_m2"),
    })


def lease_distribution(lease: DataFrame, by: str) -> DataFrame:
    """By contract_type or tenant_type."""
    measures = {"contracts_count": F.count(F.lit(1)), "total_area_m2": F.sum("area_m2")}
    return win.win_share_of_total(lease, by, measures, "total_area_m2")


def lease_marts(lease: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(kpis, contracts, tenants, premises) from one pass over the leases.

    The leases are first folded to one row per combination of the three short type columns; every
    mart is then an aggregate of that table. It is stored, so the four marts do not rescan.
    """
    spark = lease.sparkSession
    path = scratch_path(spark, "lease-cube")
    lease.groupBy("contract_type", "tenant_type", "premise_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_rent_aed").alias("rent"), F.sum("area_m2").alias("area"),
        F.sum("rent_per_m2").alias("rpm"), F.count("rent_per_m2").alias("rpm_n"),
    ).write.parquet(path)
    cube = spark.read.parquet(path)
    kpis = agg.agg_kpi_global(cube, {
        "total_contracts": F.sum("n"), "total_rental_value_aed": F.sum("rent"),
        "total_area_km2": F.sum("area") / 1e6, "avg_rent_per_m2": F.try_divide(F.sum("rpm"), F.sum("rpm_n")),
    })
    measures = {"contracts_count": F.sum("n"), "total_area_m2": F.sum("area")}
    by = lambda key: win.win_share_of_total(cube, key, measures, "total_area_m2")
    premises = win.topk_after_group(cube, "premise_type", F.sum("area") / 1e6, "total_area_km2")
    return kpis, by("contract_type"), by("tenant_type"), premises


def lease_top_property_types(lease: DataFrame) -> DataFrame:
    return win.topk_after_group(lease, "premise_type", F.sum("area_m2") / 1e6, "total_area_km2")


def v_lease_transactions(
    lease: DataFrame, geom: DataFrame, kpis: DataFrame | None = None, contracts: DataFrame | None = None,
    tenants: DataFrame | None = None, premises: DataFrame | None = None,
) -> DataFrame:
    """The optional frames are the stored marts; each one missing costs a pass over the leases."""
    kpis = lease_kpis(lease) if kpis is None else kpis
    contracts = lease_distribution(lease, "contract_type") if contracts is None else contracts
    tenants = lease_distribution(lease, "tenant_type") if tenants is None else tenants
    premises = lease_top_property_types(lease) if premises is None else premises

    def named(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn("_id", F.col(key))

    flat = flatten(
        lease,
        (*_geom(geom, "lease_id"), "left"),
        (named(contracts, "contract_type"), "contract_type",
         {"_id": "dist_contract_type", "contracts_count": "dist_contracts_count",
          "total_area_m2": "dist_contract_area_m2", "percentage": "dist_contract_percentage"}, "left"),
        (named(tenants, "tenant_type"), "tenant_type",
         {"_id": "dist_tenant_type", "contracts_count": "dist_tenant_count",
          "total_area_m2": "dist_tenant_area_m2", "percentage": "dist_tenant_percentage"}, "left"),
        (named(premises, "premise_type"), "premise_type",
         {"_id": "top_premise_type", "total_area_km2": "top_premise_area_km2"}, "left"),
    )
    return join_on_true_scalar(flat, kpis)


# --- population, places, logistics ------------------------------------------------------


def population_kpis(population: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(population, {
        "total_areas": F.count(F.lit(1)), "total_population": F.sum("total_population"),
        "total_residents": F.sum("residents"), "total_workforce": F.sum("workforce"),
    })


def v_population(population: DataFrame, geom: DataFrame, demographics: DataFrame, ages: DataFrame, genders: DataFrame) -> DataFrame:
    base = flatten(population, (*_geom(geom, "population_id", "area_km2", "polygon_area_km2"), "inner"))
    children = [
        demographics.withColumnRenamed("people_count", "nationality_people"),
        ages.withColumnRenamed("people_count", "age_people"),
        genders.withColumnRenamed("people_count", "gender_people"),
    ]
    return join_multi_child_fanout(base, "population_id", children)


def poi_top_locations(poi: DataFrame) -> DataFrame:
    combined = (F.col("avg_weekday_footfall") + F.col("avg_weekend_footfall")).alias("combined_footfall")
    return win.topk_simple(poi.select("poi_id", combined), "combined_footfall", "poi_id")


def poi_category_distribution(poi: DataFrame) -> DataFrame:
    both = F.sum(F.col("avg_weekday_footfall") + F.col("avg_weekend_footfall"))
    return win.win_share_of_total(poi, "category", {"total_footfall": both}, "total_footfall")


def poi_kpis(poi: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(poi, {
        "total_pois": F.count(F.lit(1)), "avg_weekday_footfall": F.avg("avg_weekday_footfall"),
        "avg_weekend_footfall": F.avg("avg_weekend_footfall"),
    })


def v_points_of_interests(poi: DataFrame, geom: DataFrame) -> DataFrame:
    share = poi_category_distribution(poi).withColumn("_id", F.col("category"))
    top = poi_top_locations(poi).withColumn("_id", F.col("poi_id"))
    return flatten(
        poi,
        (*_geom(geom, "poi_id"), "left"),
        (share, "category", {"_id": "dist_category", "total_footfall": "dist_category_footfall", "percentage": "dist_category_percentage"}, "left"),
        (top, "poi_id", {"_id": "top_poi_id", "combined_footfall": "top_poi_combined_footfall"}, "left"),
    )


def logistics_top_hubs(logistics: DataFrame) -> DataFrame:
    return win.topk_simple(logistics.select("logistics_id", "annual_throughput_mt"), "annual_throughput_mt", "logistics_id")


def logistics_top_types(logistics: DataFrame) -> DataFrame:
    return win.topk_after_group(logistics, "cargo_type", F.sum("annual_throughput_mt"), "total_throughput_mt")


def logistics_type_distribution(logistics: DataFrame) -> DataFrame:
    return win.win_share_of_total(logistics, "cargo_type", {"total_throughput_mt": F.sum("annual_throughput_mt")}, "total_throughput_mt")


def v_freight_logistics(logistics: DataFrame, geom: DataFrame) -> DataFrame:
    share = logistics_type_distribution(logistics).withColumn("_id", F.col("cargo_type"))
    hubs = logistics_top_hubs(logistics).withColumn("_id", F.col("logistics_id"))
    types = logistics_top_types(logistics).withColumn("_id", F.col("cargo_type"))
    return flatten(
        logistics,
        (*_geom(geom, "logistics_id"), "left"),
        (share, "cargo_type", {"_id": "dist_cargo_type", "total_throughput_mt": "dist_cargo_throughput", "percentage": "dist_cargo_percentage"}, "left"),
        (hubs, "logistics_id", {"_id": "top_hub_id", "annual_throughput_mt": "top_hub_throughput"}, "left"),
        (types, "cargo_type", {"_id": "top_type", "total_throughput_mt": "top_type_throughput"}, "left"),
    )


# --- companies, buildings, supply -------------------------------------------------------


def company_type_distribution(company: DataFrame) -> DataFrame:
    return win.win_share_of_total(company, "business_type", {"companies_count": F.count(F.lit(1))}, "companies_count")


def company_size_distribution(company: DataFrame) -> DataFrame:
    hist = agg.agg_histogram_width_bucket(company, "headcount", *HEADCOUNT_BUCKETS, count_name="companies_count")
    return hist.withColumnRenamed("bucket", "headcount_bucket")


def company_top_types(company: DataFrame) -> DataFrame:
    return win.topk_after_group(company, "business_type", F.count(F.lit(1)), "companies_count")


def company_kpis(company: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(company, {
        "total_companies": F.count(F.lit(1)), "avg_headcount": F.avg("headcount"), "avg_customer_rating": F.avg("customer_rating"),
    })


def v_companies(company: DataFrame, geom: DataFrame) -> DataFrame:
    share = company_type_distribution(company).withColumn("_id", F.col("business_type"))
    top = company_top_types(company).withColumn("_id", F.col("business_type"))
    flat = flatten(
        company,
        (*_geom(geom, "company_id"), "left"),
        (share, "business_type", {"_id": "dist_business_type", "companies_count": "dist_business_count", "percentage": "dist_business_percentage"}, "left"),
        (top, "business_type", {"_id": "top_business_type", "companies_count": "top_business_count"}, "left"),
    )
    sizes = company_size_distribution(company).withColumnRenamed("companies_count", "size_bucket_count")
    return join_on_true_fanout(flat, sizes)


def age_group(as_of: str, year: str = "completion_year") -> Column:
    """Age label; an unknown year counts as the oldest group."""
    age = F.year(F.lit(as_of).cast("date")) - F.col(year)
    (new, new_name), (modern, modern_name) = AGE_GROUPS
    return F.when(age <= new, new_name).when(age <= modern, modern_name).otherwise(OLDEST_GROUP)


def building_age_profile(building: DataFrame, as_of: str) -> DataFrame:
    labelled = building.select(age_group(as_of).alias("age_group"))
    return win.win_share_of_total(labelled, "age_group", {"buildings_count": F.count(F.lit(1))}, "buildings_count")


def building_status_distribution(building: DataFrame) -> DataFrame:
    return agg.agg_count_by_key(building, "construction_status", "buildings_count")


def building_kpis(building: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(building, {
        "total_buildings": F.count(F.lit(1)), "total_floor_area_m2": F.sum("floor_area_m2"),
        "total_properties_count": F.sum("properties_count"), "avg_completion_year": F.avg("completion_year"),
    })


def v_buildings(building: DataFrame, geom: DataFrame, as_of: str) -> DataFrame:
    """The age label is computed in place: it depends on the row alone."""
    flat = flatten(building, (*_geom(geom, "building_id", "area_km2", "polygon_area_km2"), "left"))
    return flat.withColumn("age_group", age_group(as_of))


def supply_listing_type(supply: DataFrame) -> DataFrame:
    measures = {"listings_count": F.count(F.lit(1)), "total_area_m2": F.sum("total_area_m2")}
    return win.win_share_of_total(supply, "listing_type", measures, "total_area_m2")


def supply_top_subtypes(supply: DataFrame) -> DataFrame:
    return win.topk_after_group(supply, "subtype", F.count(F.lit(1)), "listings_count")


def supply_kpis(supply: DataFrame) -> DataFrame:
    return agg.agg_kpi_global(supply, {
        "total_listings": F.count(F.lit(1)), "avg_price_per_m2": F.avg("price_per_m2"),
        "total_listed_area_m2": F.sum("total_area_m2"), "avg_cap_rate": F.avg("estimated_cap_rate"),
    })


def v_real_estate_supply(supply: DataFrame, geom: DataFrame) -> DataFrame:
    kinds = supply_listing_type(supply).withColumn("_id", F.col("listing_type"))
    top = supply_top_subtypes(supply).withColumn("_id", F.col("subtype"))
    return flatten(
        supply,
        (*_geom(geom, "supply_id"), "left"),
        (kinds, "listing_type", {"_id": "dist_listing_type", "listings_count": "dist_listing_count",
                                 "total_area_m2": "dist_listing_area_m2", "percentage": "dist_listing_percentage"}, "left"),
        (top, "subtype", {"_id": "top_subtype", "listings_count": "top_subtype_count"}, "left"),
    )
