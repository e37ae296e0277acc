"""Projection, cleaning and validation of readings and features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions.scalar import natural_id, nan_to_null, tri_state_bool

# Null defaults, validation bounds and category limits of the metering domain.
METER_DEFAULTS = {
    "energy_consumption": 15.0,
    "current_reading": 10.0,
    "power_factor": 0.95,
    "frequency": 50.0,
    "voltage": 220.0,
}
WAREHOUSE_DEFAULTS = {k: v for k, v in METER_DEFAULTS.items() if k != "voltage"}
VOLTAGE_RANGE = (200, 250)
CURRENT_RANGE = (0, 100)
CATEGORY_LIMITS = (10, 25)
ANOMALY_ENERGY = 50

# Source prefixes and the feature type each stands for.
SOURCE_PREFIXES = {
    "OSM_Dubai_Buildings": "building",
    "OSM_Dubai_Roads": "road",
    "OSM_Dubai_POIs": "poi",
    "OSM_Dubai_Landuse": "landuse",
}

# Output column -> (JSON attribute, wanted value) of the cadastral field list.
CADASTRAL_FIELDS = {
    "land_id": ("tag", "land_id"),
    "land_use_type": ("tag", "land_use_type"),
    "purpose": ("caption", "Purpose"),
    "cadastral_status": ("tag", "cadastral_status"),
    "foreign_eligible": ("caption", "Foreign eligible"),
    "description": ("caption", "Description"),
}

CADASTRAL_SCHEMA = (
    "struct<id:string,name:string,wkt:string,point:struct<lon:double,lat:double>,"
    "field_groups:array<struct<fields:array<struct<tag:string,caption:string,value:string>>>>>"
)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    return df.fillna(dict(METER_DEFAULTS if defaults is None else defaults))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; values that do not parse become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def coerce_schema(df: DataFrame, schema: T.StructType, default: float = 0.0) -> DataFrame:
    """Force a frame of any column types into `schema`: numbers that fail to cast become `default`."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(default).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sanitize(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats})


def valid_meter_row(v: tuple = VOLTAGE_RANGE, i: tuple = CURRENT_RANGE) -> Column:
    return (
        F.col("meter_id").isNotNull()
        & (F.col("energy_consumption") > 0)
        & F.col("voltage").between(*v)
        & F.col("current_reading").between(*i)
    )


def validate_meter(df: DataFrame, v: tuple = VOLTAGE_RANGE, i: tuple = CURRENT_RANGE) -> DataFrame:
    """Keep rows with a meter, positive energy and readings within the bounds (inclusive)."""
    return df.where(valid_meter_row(v, i))


def derive_time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Parsed timestamp plus date, year … minute and partition_date."""
    if isinstance(df.schema[ts].dataType, T.StringType):
        df = df.withColumn(ts, F.expr(f"try_to_timestamp(`{ts}`)").cast("timestamp_ntz"))
    t = F.col(ts)
    return df.withColumns(
        {
            "date": F.to_date(t),
            "year": F.year(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "hour": F.hour(t),
            "minute": F.minute(t),
            "partition_date": F.to_date(t),
        }
    )


def consumption_category(
    df: DataFrame, col: str = "energy_consumption", lo: float = CATEGORY_LIMITS[0], hi: float = CATEGORY_LIMITS[1]
) -> DataFrame:
    """LOW / MEDIUM / HIGH; an unknown value counts as HIGH."""
    c = F.col(col)
    return df.withColumn("consumption_category", F.when(c < lo, "LOW").when(c < hi, "MEDIUM").otherwise("HIGH"))


def anomaly_flag(df: DataFrame, e: float = ANOMALY_ENERGY, v: tuple = VOLTAGE_RANGE) -> DataFrame:
    odd = (F.col("energy_consumption") > e) | (F.col("voltage") < v[0]) | (F.col("voltage") > v[1])
    return df.withColumn("is_anomaly", F.when(odd, 1).otherwise(0))


def audit_timestamp(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp() if as_of is None else as_of)


def project_output_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def filter_not_null_operator(df: DataFrame, col: str = "operator") -> DataFrame:
    return df.where(F.col(col).isNotNull())


def filter_by_date(df: DataFrame, ts: str, date: str) -> DataFrame:
    """Rows of one calendar day, as a half-open range so that the scan can skip row groups."""
    kind = df.schema[ts].dataType.simpleString()
    day = F.lit(date).cast("date")
    return df.where((F.col(ts) >= day.cast(kind)) & (F.col(ts) < F.date_add(day, 1).cast(kind)))


def classify_source(source: Column, prefixes: Mapping[str, str] | None = None) -> Column:
    result = None
    for prefix, kind in (SOURCE_PREFIXES if prefixes is None else prefixes).items():
        test = source.startswith(prefix)
        result = F.when(test, kind) if result is None else result.when(test, kind)
    return result


def classify_source_like(df: DataFrame, col: str, prefixes: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumn("feature_type", classify_source(F.col(col), prefixes))


def filter_feature_type(df: DataFrame, kind: str, payload: str = "payload", key: str = "ingest_id") -> DataFrame:
    """Typed rows of one feature type; the id is a hash of the natural key, so re-runs agree."""
    j = lambda path: F.get_json_object(F.col(payload), path)
    rows = df.where(F.col("feature_type") == kind)
    if kind == "landuse":
        return rows.select(natural_id(F.lit("parcel"), F.col(key)).alias("parcel_id"), j("$.fclass").alias("zoning"))
    return rows.select(
        natural_id(F.lit(kind), F.col(key)).alias(f"{kind}_id"),
        j("$.name").alias("name"),
        j("$.fclass").alias(f"{kind}_type"),
        F.lit("active").alias("status"),
        j("$.osm_id").alias("osm_id"),
    )


def filter_subtype_project(df: DataFrame, subtype: str = "district") -> DataFrame:
    """District items of a places feed: id, names (default and Arabic), point and outline."""
    return df.where(F.col("subtype") == subtype).select(
        "id",
        "name",
        F.col("`name[ar]`").alias("name_ar"),
        F.col("point.lon").alias("lon"),
        F.col("point.lat").alias("lat"),
        F.col("geometry.selection").alias("wkt"),
    )


def unpivot_fields_by_tag(
    df: DataFrame, payload: str = "payload", spec: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """First matching value of nested `field_groups[].fields[]` per wanted column, without a shuffle."""
    parsed = df.withColumn("_p", F.from_json(F.col(payload), CADASTRAL_SCHEMA)).withColumn(
        "_f", F.flatten(F.transform(F.col("_p.field_groups"), lambda g: g["fields"]))
    )

    def pick(attribute: str, wanted: str) -> Column:
        return F.get(F.filter(F.col("_f"), lambda f: f[attribute] == wanted), F.lit(0))["value"]

    values = {name: pick(*rule) for name, rule in (CADASTRAL_FIELDS if spec is None else spec).items()}
    if "land_id" in values:
        values["land_id"] = values["land_id"].try_cast("decimal(38,10)")
    if "foreign_eligible" in values:
        values["foreign_eligible"] = tri_state_bool(values["foreign_eligible"])
    return parsed.select(
        F.col("_p.id").alias("plot_id"),
        "district_id",
        "district_name",
        F.col("_p.name").alias("plot_number"),
        *[c.alias(n) for n, c in values.items()],
    )


def rename_affixes(df: DataFrame, prefix: str = "", suffix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Strip a prefix or suffix from column names, e.g. the marks a spatial join leaves behind."""
    names = {}
    for c in df.columns:
        new = c.removeprefix(prefix) if prefix else c
        new = new.removesuffix(suffix) if suffix else new
        if c not in keep and new != c and new not in df.columns:
            names[c] = new
    return df.withColumnsRenamed(names)


def clean_readings(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Fill, validate, derive time parts, category and anomaly flag: all in one narrow stage."""
    rows = validate_meter(fill_defaults(df, defaults))
    return anomaly_flag(consumption_category(derive_time_parts(rows)))
