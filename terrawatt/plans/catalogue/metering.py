"""Meter readings: scan, cleaning, grains."""

from pyspark.sql import functions as F

from terrawatt.operators import aggregates as agg
from terrawatt.operators import cleaning as cl
from terrawatt.plans.registry import query
from terrawatt.session import scratch_path
from terrawatt.sources import scans, sinks

FILLED = """SELECT event_id, meter_id, timestamp,
    coalesce(energy_consumption, 15.0) AS energy_consumption, coalesce(voltage, 220.0) AS voltage,
    coalesce(current_reading, 10.0) AS current_reading, coalesce(power_factor, 0.95) AS power_factor,
    coalesce(frequency, 50.0) AS frequency FROM meter_readings"""
VALID = f"""SELECT * FROM ({FILLED}) WHERE meter_id IS NOT NULL AND energy_consumption > 0
    AND voltage BETWEEN 200 AND 250 AND current_reading BETWEEN 0 AND 100"""
CLEAN = f"""SELECT *, CAST(timestamp AS DATE) AS date, year(timestamp) AS year, month(timestamp) AS month,
    day(timestamp) AS day, hour(timestamp) AS hour, minute(timestamp) AS minute,
    CAST(timestamp AS DATE) AS partition_date,
    CASE WHEN energy_consumption < 10 THEN 'LOW' WHEN energy_consumption < 25 THEN 'MEDIUM' ELSE 'HIGH' END AS consumption_category,
    CASE WHEN energy_consumption > 50 OR voltage < 200 OR voltage > 250 THEN 1 ELSE 0 END AS is_anomaly
    FROM ({VALID})"""

FIVE = "energy_consumption voltage current_reading power_factor frequency"


def clean(t):
    return cl.clean_readings(t.meter_readings)


@query("fill_defaults", FILLED, FIVE)
def _(t):
    return cl.fill_defaults(t.meter_readings)


@query("cast_columns", """SELECT event_id, CAST(TRY_CAST(o AS INTEGER) AS INTEGER) AS as_int, TRY_CAST(v AS DOUBLE) AS as_double
    FROM (SELECT event_id, event_type AS o, CASE WHEN event_id % 4 = 0 THEN 'bad' ELSE CAST(user_id AS VARCHAR) END AS v FROM events)""",
       "as_double")
def _(t):
    raw = t.events.select(
        "event_id", F.col("event_type").alias("as_int"),
        F.when(F.col("event_id") % 4 == 0, "bad").otherwise(F.col("user_id").cast("string")).alias("as_double"),
    )
    return cl.cast_columns(raw, {"as_int": "int", "as_double": "double"})


@query("validate_meter", VALID, FIVE)
def _(t):
    return cl.validate_meter(cl.fill_defaults(t.meter_readings))


@query("validate_meter__no_voltage_fill", f"""SELECT event_id, meter_id, energy_consumption, voltage FROM (
    SELECT event_id, meter_id, coalesce(energy_consumption, 15.0) AS energy_consumption, voltage,
           coalesce(current_reading, 10.0) AS current_reading FROM meter_readings)
    WHERE meter_id IS NOT NULL AND energy_consumption > 0 AND voltage BETWEEN 200 AND 250 AND current_reading BETWEEN 0 AND 100""",
       "energy_consumption voltage")
def _(t):
    rows = cl.validate_meter(cl.fill_defaults(t.meter_readings, cl.WAREHOUSE_DEFAULTS))
    return rows.select("event_id", "meter_id", "energy_consumption", "voltage")


@query("derive_time_parts", """SELECT event_id, CAST(timestamp AS DATE) AS date, year(timestamp) AS year, month(timestamp) AS month,
    day(timestamp) AS day, hour(timestamp) AS hour, minute(timestamp) AS minute, CAST(timestamp AS DATE) AS partition_date
    FROM meter_readings""")
def _(t):
    parts = cl.derive_time_parts(t.meter_readings.select("event_id", "timestamp"))
    return parts.drop("timestamp")


@query("consumption_category", """SELECT event_id, CASE WHEN energy_consumption < 10 THEN 'LOW' WHEN energy_consumption < 25
    THEN 'MEDIUM' ELSE 'HIGH' END AS consumption_category FROM meter_readings""")
def _(t):
    return cl.consumption_category(t.meter_readings).select("event_id", "consumption_category")


@query("anomaly_flag", """SELECT event_id, CASE WHEN energy_consumption > 50 OR voltage < 200 OR voltage > 250 THEN 1 ELSE 0 END
    AS is_anomaly FROM meter_readings""")
def _(t):
    return cl.anomaly_flag(t.meter_readings).select("event_id", "is_anomaly")


@query("audit_timestamp", "SELECT event_id, TIMESTAMP '2024-01-31 00:00:00' AS processed_at FROM meter_readings")
def _(t):
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return cl.audit_timestamp(t.meter_readings.select("event_id"), at)


@query("project_output_columns", f"""SELECT meter_id, timestamp, energy_consumption, voltage, current_reading, power_factor,
    frequency FROM ({CLEAN})""", FIVE)
def _(t):
    return cl.project_output_columns(clean(t), ["meter_id", "timestamp", *FIVE.split()])


@query("filter_not_null_operator", "SELECT equipment_id, operator FROM telemetry WHERE operator IS NOT NULL")
def _(t):
    return cl.filter_not_null_operator(t.telemetry).select("equipment_id", "operator")


@query("filter_by_date", """SELECT event_id, meter_id, timestamp FROM meter_readings
    WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-06'""")
def _(t):
    return cl.filter_by_date(t.meter_readings, "timestamp", "2024-01-05").select("event_id", "meter_id", "timestamp")


HOURLY = f"""SELECT meter_id, date, hour, partition_date, sum(energy_consumption) AS total_energy_hourly,
    avg(energy_consumption) AS avg_energy_hourly, avg(voltage) AS avg_voltage_hourly, avg(current_reading) AS avg_current_hourly,
    max(energy_consumption) AS max_consumption_hourly, min(energy_consumption) AS min_consumption_hourly,
    count(*) AS record_count_hourly, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count_hourly, 'HOURLY' AS aggregation_type
    FROM ({CLEAN}) GROUP BY ALL"""
_MEASURES = "total_energy_{0} avg_energy_{0}:8 avg_voltage_{0}:8 avg_current_{0}:8 max_consumption_{0} min_consumption_{0}"


@query("agg_meter_hourly", HOURLY, _MEASURES.format("hourly"))
def _(t):
    return agg.agg_meter_hourly(clean(t))


DAILY = f"""SELECT meter_id, date, partition_date, sum(energy_consumption) AS total_energy_daily,
    avg(energy_consumption) AS avg_energy_daily, avg(voltage) AS avg_voltage_daily, avg(current_reading) AS avg_current_daily,
    max(energy_consumption) AS max_consumption_daily, min(energy_consumption) AS min_consumption_daily,
    stddev_samp(energy_consumption) AS std_energy_daily, count(*) AS record_count_daily,
    CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count_daily, 'DAILY' AS aggregation_type FROM ({CLEAN}) GROUP BY ALL"""


@query("agg_meter_daily", DAILY, _MEASURES.format("daily") + " std_energy_daily")
def meter_daily(t):
    return agg.agg_meter_daily(clean(t))


_SUMMARY = """sum(energy_consumption) AS total_energy_meter, avg(energy_consumption) AS avg_energy_meter,
    max(energy_consumption) AS peak_consumption, count(*) AS total_readings, count(DISTINCT date) AS active_days,
    CAST(sum(is_anomaly) AS BIGINT) AS total_anomalies, 'METER_SUMMARY' AS aggregation_type"""


@query("agg_meter_summary", f"SELECT meter_id, partition_date, {_SUMMARY} FROM ({CLEAN}) GROUP BY meter_id, partition_date",
       "total_energy_meter avg_energy_meter:8 peak_consumption")
def _(t):
    return agg.agg_meter_summary(clean(t))


@query("agg_meter_summary__by_meter", f"SELECT meter_id, {_SUMMARY} FROM ({CLEAN}) GROUP BY meter_id",
       "total_energy_meter avg_energy_meter:8 peak_consumption")
def _(t):
    return agg.agg_meter_summary(clean(t), ["meter_id"], exact_days=True)


@query("agg_levels_rollup", f"""SELECT meter_id, date, hour,
    CASE GROUPING_ID(meter_id, date, hour) WHEN 0 THEN 'HOURLY' WHEN 1 THEN 'DAILY' ELSE 'METER_SUMMARY' END AS aggregation_type,
    sum(energy_consumption) AS total_energy, avg(energy_consumption) AS avg_energy, max(energy_consumption) AS max_energy,
    min(energy_consumption) AS min_energy, count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS anomalies
    FROM ({CLEAN}) GROUP BY GROUPING SETS ((meter_id, date, hour), (meter_id, date), (meter_id))""",
       "total_energy avg_energy:8 max_energy min_energy")
def _(t):
    return agg.agg_levels_rollup(clean(t))


REPORT = f"""SELECT meter_id, date, sum(energy_consumption) AS total_energy, avg(voltage) AS avg_voltage,
    avg(current_reading) AS avg_current, max(energy_consumption) AS max_consumption, count(*) AS record_count
    FROM ({CLEAN}) GROUP BY meter_id, date"""


@query("agg_daily_energy_report", REPORT, "total_energy avg_voltage:8 avg_current:8 max_consumption")
def _(t):
    return agg.agg_daily_energy_report(clean(t))


@query("agg_operator_region", """SELECT operator, region, count(*) AS equipment_count, avg(cpu_usage) AS avg_cpu_usage,
    avg(network_throughput) AS avg_throughput, CAST(sum(active_connections) AS BIGINT) AS total_connections
    FROM telemetry WHERE operator IS NOT NULL GROUP BY operator, region""", "avg_cpu_usage avg_throughput")
def _(t):
    return agg.agg_operator_region(cl.filter_not_null_operator(t.telemetry))


@query("agg_partial_states", f"""SELECT meter_id, date_trunc('hour', timestamp) AS bucket, sum(energy_consumption) AS sum_e,
    count(energy_consumption) AS cnt_e, count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM ({CLEAN}) GROUP BY ALL""", "sum_e")
def _(t):
    return agg.agg_partial_states(clean(t))


@query("merge_partial_states", f"""SELECT meter_id, date_trunc('day', timestamp) AS bucket, sum(energy_consumption) AS total_energy,
    avg(energy_consumption) AS avg_energy, count(*) AS readings_count, CAST(sum(is_anomaly) AS BIGINT) AS anomalies_count
    FROM ({CLEAN}) GROUP BY ALL""", "total_energy avg_energy:8")
def _(t):
    return agg.merge_partial_states(agg.agg_partial_states(clean(t)), "day").withColumn("bucket", F.col("bucket"))


@query("agg_table_summary", f"""SELECT count(*) AS total_daily_records, count(DISTINCT meter_id) AS meters_with_daily_data,
    min(date) AS earliest_date, max(date) AS latest_date, avg(total_energy) AS avg_daily_energy,
    sum(total_energy) AS total_energy_all_meters FROM ({REPORT})""", "avg_daily_energy total_energy_all_meters")
def _(t):
    return agg.agg_table_summary(agg.agg_daily_energy_report(clean(t)), {
        "total_daily_records": F.count(F.lit(1)), "meters_with_daily_data": F.count_distinct("meter_id"),
        "earliest_date": F.min("date"), "latest_date": F.max("date"),
        "avg_daily_energy": F.avg("total_energy"), "total_energy_all_meters": F.sum("total_energy"),
    })


@query("agg_table_summary__readings", """SELECT count(*) AS total_records, count(DISTINCT meter_id) AS unique_meters,
    min(timestamp) AS earliest_timestamp, max(timestamp) AS latest_timestamp, avg(energy_consumption) AS avg_energy_consumption,
    avg(voltage) AS avg_voltage, avg(current_reading) AS avg_current, count(*) - count(energy_consumption) AS null_energy_count,
    count(*) - count(voltage) AS null_voltage_count FROM meter_readings""", "avg_energy_consumption avg_voltage avg_current")
def _(t):
    return agg.agg_table_summary(t.meter_readings, {
        "total_records": F.count(F.lit(1)), "unique_meters": F.count_distinct("meter_id"),
        "earliest_timestamp": F.min("timestamp"), "latest_timestamp": F.max("timestamp"),
        "avg_energy_consumption": F.avg("energy_consumption"), "avg_voltage": F.avg("voltage"),
        "avg_current": F.avg("current_reading"),
        "null_energy_count": F.count_if(F.col("energy_consumption").isNull()),
        "null_voltage_count": F.count_if(F.col("voltage").isNull()),
    })


@query("agg_distinct_count", "SELECT count(DISTINCT (user_id, event_type)) AS distinct_count FROM events")
def _(t):
    return agg.agg_distinct_count(t.events, ["user_id", "event_type"])


@query("agg_conditional_counts", """SELECT count(*) AS total, count(*) FILTER (energy_consumption > 0) AS positive,
    count(*) FILTER (voltage BETWEEN 200 AND 250) AS in_voltage, count(*) FILTER (energy_consumption IS NULL) AS null_energy
    FROM meter_readings""")
def _(t):
    return agg.agg_conditional_counts(t.meter_readings, {
        "positive": F.col("energy_consumption") > 0, "in_voltage": F.col("voltage").between(200, 250),
        "null_energy": F.col("energy_consumption").isNull(),
    }, total="total")


@query("agg_first_last", """SELECT count(*) AS records_count, min(timestamp) AS first_reading, max(timestamp) AS last_reading
    FROM meter_readings WHERE CAST(timestamp AS DATE) = DATE '2024-01-05'""")
def _(t):
    return agg.agg_first_last(cl.filter_by_date(t.meter_readings, "timestamp", "2024-01-05"))


# --- scans over a partitioned copy of the readings --------------------------------------


def _lake(t) -> str:
    """The readings written as a `date=` partitioned table, as the ingestion job leaves them."""
    path = scratch_path(t.spark, "lake")
    rows = t.meter_readings.withColumn("date", F.to_date("timestamp"))
    # One file per day: the shuffle by date keeps a day's rows together; AQE splits large days.
    sinks.sink_parquet_snappy(rows.repartition("date"), path)
    return path


@query("scan_parquet_partition", """SELECT event_id, meter_id, CAST(timestamp AS DATE) AS date FROM meter_readings
    WHERE CAST(timestamp AS DATE) = DATE '2024-01-07'""")
def _(t):
    return scans.scan_parquet_partition(t.spark, _lake(t), "2024-01-07").select("event_id", "meter_id", "date")


@query("latest_partition", "SELECT max(CAST(timestamp AS DATE)) AS date FROM meter_readings")
def _(t):
    return scans.latest_partition(t.spark.read.parquet(_lake(t)))


@query("scan_latest_partition", """SELECT event_id, meter_id FROM meter_readings WHERE CAST(timestamp AS DATE) =
    (SELECT max(CAST(timestamp AS DATE)) FROM meter_readings)""")
def _(t):
    return scans.scan_latest_partition(t.spark, _lake(t)).select("event_id", "meter_id")


@query("partition_stats", "SELECT CAST(timestamp AS DATE) AS partition, count(*) AS rows FROM meter_readings GROUP BY 1")
def _(t):
    from terrawatt.operators.changes import partition_stats

    return partition_stats(t.meter_readings, F.to_date("timestamp"))


@query("scan_coerce_schema", """SELECT meter_id, CAST(timestamp AS VARCHAR) IS NOT NULL AS has_time, coalesce(energy_consumption, 0.0) AS energy_consumption,
    coalesce(voltage, 0.0) AS voltage, coalesce(current_reading, 0.0) AS current_reading,
    coalesce(power_factor, 0.0) AS power_factor, coalesce(frequency, 0.0) AS frequency FROM meter_readings""", FIVE)
def _(t):
    loose = t.meter_readings.withColumn("energy_consumption", F.col("energy_consumption").cast("string"))
    typed = scans.scan_coerce_schema(loose, scans.METER_SCHEMA)
    return typed.withColumn("has_time", F.col("timestamp").isNotNull()).drop("timestamp")


@query("scan_kafka_batch", """SELECT CAST(json_extract_string(payload, '$.meter_id') AS VARCHAR) AS meter_id,
    CAST(json_extract_string(payload, '$.kwh_usage') AS DOUBLE) AS kwh_usage,
    json_extract_string(payload, '$.region') AS region FROM producer_json""", "kwh_usage")
def _(t):
    values = t.producer_json.select(F.encode("payload", "UTF-8").alias("value"))
    return scans.scan_kafka_batch(values, "meter_id string, kwh_usage double, region string")
