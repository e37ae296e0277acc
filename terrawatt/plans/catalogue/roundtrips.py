"""Sources and sinks: a table is written with one operator and read back with another."""

from pyspark.sql import functions as F

from terrawatt.functions import geo
from terrawatt.plans.registry import query
from terrawatt.session import scratch_path
from terrawatt.sources import scans, sinks

READING = "SELECT event_id, meter_id, timestamp, energy_consumption FROM meter_readings"


def readings(t):
    return t.meter_readings.select("event_id", "meter_id", "timestamp", "energy_consumption")


def place(t, label):
    return scratch_path(t.spark, label)


@query("sink_parquet_snappy", f"SELECT *, strftime(timestamp, '%Y-%m-%d') AS day FROM ({READING})")
def _(t):
    path = place(t, "snappy")
    dated = readings(t).withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    sinks.sink_parquet_snappy(dated, path)
    return t.spark.read.parquet(path).select(*readings(t).columns, F.date_format("date", "yyyy-MM-dd").alias("day"))


@query("sink_jsonl_batches", READING)
def _(t):
    path = place(t, "jsonl")
    rows = readings(t)
    sinks.sink_jsonl_batches(rows, path, per=5_000)
    return t.spark.read.schema(rows.schema).json(path)


@query("sink_multi_export", f"SELECT kind, event_id, meter_id FROM ({READING}), (VALUES ('csv'), ('json'), ('parquet')) AS formats(kind)")
def _(t):
    path = place(t, "export")
    rows = t.meter_readings.select("event_id", "meter_id")
    sinks.sink_multi_export(rows, path)
    back = {k: t.spark.read.schema(rows.schema).option("header", k == "csv").format(k).load(f"{path}/{k}") for k in ("csv", "json", "parquet")}
    parts = [df.select(F.lit(k).alias("kind"), "event_id", "meter_id") for k, df in back.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("route_table_name", """SELECT CASE WHEN region_frame = 'raw_data' THEN 'smart_meter_raw' WHEN region_frame IN ('hourly_aggregates', 'daily_aggregates')
    THEN 'meter_aggregates' ELSE region_frame END AS table_name, count(*) AS n FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'raw_data'
    WHEN 1 THEN 'hourly_aggregates' WHEN 2 THEN 'daily_aggregates' ELSE 'other' END AS region_frame FROM meter_readings) GROUP BY 1""")
def _(t):
    root = place(t, "routed")
    frames = {0: "raw_data", 1: "hourly_aggregates", 2: "daily_aggregates", 3: "other"}
    for k, frame in frames.items():
        part = t.meter_readings.where(F.col("event_id") % 4 == k).select("event_id")
        part.write.mode("append").parquet(f"{root}/table_name={sinks.route_table_name(frame)}")
    return t.spark.read.parquet(root).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


@query("full_refresh", READING)
def _(t):
    path = place(t, "refresh")
    readings(t).where("event_id % 2 = 0").write.parquet(path)
    sinks.full_refresh(readings(t), path)
    return t.spark.read.parquet(path)


@query("mv_refresh", """SELECT meter_id, count(*) AS n, 2 AS version FROM meter_readings GROUP BY meter_id""")
def _(t):
    path = place(t, "mv")
    counts = t.meter_readings.groupBy("meter_id").agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(1))
    sinks.mv_refresh(counts, path)
    # The second refresh is computed from what the first has stored.
    return sinks.mv_refresh(t.spark.read.parquet(path).withColumn("version", F.col("version") + 1), path)


@query("compact_partition", f"SELECT *, CAST(3 AS BIGINT) AS files FROM ({READING})")
def _(t):
    path = place(t, "compact")
    readings(t).repartition(11).write.parquet(path)
    sinks.compact_partition(t.spark, path, 3, ["event_id"])
    back = t.spark.read.parquet(path)
    files = back.select("_metadata.file_name").agg(F.countDistinct("file_name")).scalar()
    return back.withColumn("files", files)


@query("etl_run_log", "SELECT 'orders' AS source_name, strftime(o_orderdate, '%Y') AS partition, TIMESTAMP '2025-06-30' AS loaded_at FROM orders GROUP BY ALL")
def _(t):
    path = place(t, "runs")
    loads = t.orders.select(F.date_format("o_orderdate", "yyyy").alias("year")).distinct().orderBy("year").collect()  # a handful of years
    for row in loads:
        sinks.etl_run_log(t.spark, "orders", row.year, path, "2025-06-30")
    return t.spark.read.parquet(path)


@query("scan_with_fallback_path", """SELECT event_id, 'hit' AS path FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
    UNION ALL SELECT event_id, 'fallback' FROM events""")
def _(t):
    path = place(t, "fallback")
    dated = t.events.select("event_id", F.to_date("ts").alias("date"))
    dated.write.partitionBy("date").parquet(path)
    last = str(dated.agg(F.max("date")).first()[0])
    hit, missed = (scans.scan_with_fallback_path(t.spark, path, d) for d in (last, "1900-01-01"))
    return hit.select("event_id", F.lit("hit").alias("path")).unionByName(missed.select("event_id", F.lit("fallback").alias("path")))


@query("scan_csv_fixed_schema", "SELECT c_custkey, c_name, c_acctbal FROM customer", "c_acctbal")
def _(t):
    path = place(t, "csv")
    rows = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    rows.write.option("header", True).option("sep", ";").csv(path)
    return scans.scan_csv_fixed_schema(t.spark, path, rows.schema)


@query("scan_csv_telemetry", """SELECT CAST(user_id AS VARCHAR) AS "equipmentId", date_trunc('second', ts) AS timestamp, event_type AS operator,
    value AS latency, CAST(event_id % 1000 AS INTEGER) AS "activeConnections" FROM events""", "latency")
def _(t):
    from pyspark.sql import types as T

    path = place(t, "telemetry")
    known = {
        "equipmentId": F.col("user_id").cast("string"), "timestamp": F.date_format("ts", scans.TELEMETRY_TIME), "operator": F.col("event_type"),
        "latency": F.col("value").cast("double"), "activeConnections": (F.col("event_id") % 1000).cast("int"),
    }
    fields = T.StructType.fromDDL(scans.TELEMETRY_SCHEMA).names
    t.events.select(*[known.get(c, F.lit(None).cast("string")).alias(c) for c in fields]).write.option("header", True).csv(path)
    return scans.scan_csv_telemetry(t.spark, path).select(*known)


@query("scan_gtfs_stops", "SELECT CAST(id AS VARCHAR) AS stop_id, lon, lat, concat('Stop ', CAST(id AS VARCHAR)) AS name FROM points", "lon lat")
def _(t):
    path = place(t, "stops")
    stops = t.points.select(F.col("id").cast("string").alias("stop_id"), F.concat(F.lit("Stop "), F.col("id").cast("string")).alias("stop_name"),
                            F.col("lon").alias("stop_lon"), F.col("lat").alias("stop_lat"))
    stops.write.option("header", True).csv(path)
    return scans.scan_gtfs_stops(t.spark, path).select("stop_id", "lon", "lat", F.get_json_object("props", "$.stop_name").alias("name"))


@query("concat_tiles", "SELECT id, lon, lat FROM points", "lon lat")
def _(t):
    root = place(t, "tiles")
    east = F.col("lon") >= 55.5
    for name, half in (("east", east), ("west", ~east | F.col("lon").isNull())):
        t.points.select("id", "lon", "lat").where(half).write.parquet(f"{root}/{name}")
    return scans.concat_tiles(t.spark, [f"{root}/east", f"{root}/west"])


@query("st_make_line", "SELECT road_id, 2 AS points, x1 AS start_x, y2 AS end_y FROM road", "start_x end_y")
def _(t):
    line = geo.st_make_line(geo.st_point(F.col("x1"), F.col("y1")), geo.st_point(F.col("x2"), F.col("y2")))
    return t.road.select("road_id", line.alias("line")).select(
        "road_id", F.size("line").alias("points"), geo.st_start_point(F.col("line"))["x"].alias("start_x"), geo.st_end_point(F.col("line"))["y"].alias("end_y")
    )
