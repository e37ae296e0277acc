"""Readers for lake tables, files and topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions import shapes
from terrawatt.operators.cleaning import coerce_schema

METER_SCHEMA = T.StructType(
    [T.StructField("meter_id", T.StringType()), T.StructField("timestamp", T.StringType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("energy_consumption", "voltage", "current_reading", "power_factor", "frequency")
    ]
)

TELEMETRY_SCHEMA = (
    "equipmentId string, timestamp timestamp_ntz, equipmentType string, operator string, region string, city string, "
    "cpuUsage double, memoryUsage double, diskUsage double, networkThroughput double, activeConnections int, "
    "droppedCalls int, latency double, temperature double, powerConsumption double, status string"
)
TELEMETRY_TIME = "yyyy-MM-dd HH:mm:ss"


def scan_parquet_partition(spark: SparkSession, base: str, date: str) -> DataFrame:
    """One `date=` partition; the filter prunes folders before any file is opened."""
    return spark.read.parquet(base).where(F.col("date") == F.lit(date).cast("date"))


def scan_with_fallback_path(spark: SparkSession, base: str, date: str) -> DataFrame:
    """The partition folder of a date or, when it is missing, the whole table."""
    try:
        return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/date={date}")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(base)


def scan_coerce_schema(df: DataFrame, schema: T.StructType, default: float = 0.0) -> DataFrame:
    return coerce_schema(df, schema, default)


def latest_partition(df: DataFrame, col: str = "date") -> DataFrame:
    """(date): the greatest partition value; on a partition column only metadata is read.

    An empty table is an error.
    """
    latest = F.max(col)
    return df.agg(
        F.when(latest.isNull(), F.raise_error(F.lit("no partition found"))).otherwise(latest).alias(col)
    )


def scan_latest_partition(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the latest `date=` partition, by a scalar subquery on the partition column."""
    table = spark.read.parquet(base)
    return table.where(F.col("date") == table.agg(F.max("date")).scalar())


def scan_csv_fixed_schema(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";") -> DataFrame:
    """Headed UTF-8 CSV with a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)


def scan_csv_telemetry(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(TELEMETRY_SCHEMA).option("header", True)
    return reader.option("timestampNTZFormat", TELEMETRY_TIME).csv(path)


def parse_json_values(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Typed columns from a topic's value column (bytes or text)."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("_d")).select("_d.*")


def scan_kafka_batch(source: DataFrame | Mapping[str, str], schema: T.StructType | str, spark: SparkSession | None = None) -> DataFrame:
    """A topic from its earliest to its latest offset, parsed.

    `source` is a frame with a `value` column, or Kafka options (the connector must be installed).
    """
    if not isinstance(source, DataFrame):
        spark = spark or SparkSession.active()
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **source}
        source = spark.read.format("kafka").options(**options).load()
    return parse_json_values(source, schema)


def scan_inline_sample(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str = METER_SCHEMA) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def scan_geojson(spark: SparkSession, path: str, id_field: str = "osm_id") -> DataFrame:
    """Features of GeoJSON collections: the id, the other properties as a map, the geometry."""
    schema = "features array<struct<properties:map<string,string>,geometry:variant>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("features"))
    return rows.select(
        F.col("properties")[id_field].alias(id_field),
        F.col("properties"),
        shapes.st_from_geojson(F.to_json("geometry")).alias("geom"),
    )


def scan_gtfs_stops(spark: SparkSession, path: str) -> DataFrame:
    """(stop_id, lon, lat, props) from a stops table; all other columns become the properties."""
    raw = spark.read.option("header", True).csv(path)
    props = F.to_json(F.struct(*[c for c in raw.columns if c not in ("stop_lon", "stop_lat")]))
    return raw.select(
        "stop_id", F.col("stop_lon").try_cast("double").alias("lon"), F.col("stop_lat").try_cast("double").alias("lat"),
        props.alias("props"),
    )


def scan_json_directory(spark: SparkSession, root: str, id_map: DataFrame, file_name: str = "plots.json") -> DataFrame:
    """(district_id, district_name, payload): elements of one JSON array file per district folder.

    The folder name with blanks for underscores is the district name; unknown names are their own id.
    `id_map` has district_name and district_id.
    """
    texts = spark.read.option("wholetext", True).text(f"{root.rstrip('/')}/*/{file_name}")
    folder = F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1)
    name = F.trim(F.replace(F.url_decode(folder), F.lit("_"), F.lit(" ")))
    rows = texts.select(
        name.alias("district_name"), F.explode(F.from_json("value", "array<variant>")).alias("_e")
    )
    return rows.join(id_map, "district_name", "left").select(
        F.coalesce("district_id", "district_name").alias("district_id"), "district_name", F.to_json("_e").alias("payload")
    )


def concat_tiles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several tile files as one frame."""
    return spark.read.parquet(*paths)


def jdbc_table_read(spark: SparkSession, url: str, table: str, props: Mapping[str, str] | None = None, **partitioning) -> DataFrame:
    """A JDBC table; pass column, lowerBound, upperBound and numPartitions for a parallel read."""
    return spark.read.jdbc(url, table, properties=dict(props or {}), **partitioning)
