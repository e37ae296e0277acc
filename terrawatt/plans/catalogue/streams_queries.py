"""Streams run to their end over the event table and read back."""

from pyspark.sql import functions as F

from terrawatt.operators import anomaly as an
from terrawatt.operators import cleaning as cl
from terrawatt.plans import datasets
from terrawatt.plans.catalogue.detection import BASE
from terrawatt.plans.catalogue.joining import CDC_ROWS, PRODUCER_ROWS
from terrawatt.plans.catalogue.metering import CLEAN
from terrawatt.plans.registry import query
from terrawatt.session import scratch_path
from terrawatt.streaming import streams as st


#: Micro-batches that a staged table is read in: results must not depend on how rows fall into them.
BATCHES = 6


def stream_of(t, name: str):
    """A derived dataset as a stream: its rows are staged as files in no particular order, which the stream reads in several batches."""
    staged = scratch_path(t.spark, f"topic-{name}")
    rows = getattr(t, name)
    files = max(BATCHES, t.spark.sparkContext.defaultParallelism)
    rows.repartition(files).write.parquet(staged)
    return st.file_stream(t.spark, staged, rows.schema, files_per_batch=-(-files // BATCHES))


def out(t) -> str:
    return scratch_path(t.spark, "stream-out")


def run(t, sdf, mode="append"):
    return st.run_to_table(sdf, out(t), mode)


@query("stream_kafka_json", "SELECT * REPLACE (CAST(kwh_usage AS DOUBLE) AS kwh_usage) FROM (" + PRODUCER_ROWS + ")", "kwh_usage")
def _(t):
    return run(t, st.stream_kafka_json(stream_of(t, "producer_json")))


_DECIMALS = ("energy_consumption", "voltage", "current_reading", "power_factor", "frequency")


@query("stream_cdc_json", "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DECIMALS) + f") FROM ({CDC_ROWS})", " ".join(_DECIMALS))
def _(t):
    return run(t, st.stream_cdc_json(stream_of(t, "cdc_json")))


@query("stream_incremental_agg", f"""SELECT meter_id, date_trunc('hour', timestamp) AS bucket, sum(energy_consumption) AS sum_e,
    count(energy_consumption) AS cnt_e, count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM ({CLEAN}) GROUP BY ALL""", "sum_e")
def _(t):
    cleaned = cl.clean_readings(stream_of(t, "meter_readings")).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return st.merge_meter_partials(st.run_partials(cleaned, out(t), st.meter_partials))


KPI = """SELECT w AS window_start, w + INTERVAL {1} MINUTE AS window_end, avg(signal_strength) AS avg_network_quality, {2}
    count(DISTINCT device_id) AS active_devices, sum(data_usage_mb) AS data_usage, avg(latency_ms) AS avg_latency, count(*) AS event_count FROM (
    SELECT *, time_bucket(INTERVAL {0} MINUTE, event_time) - to_minutes(CAST(k * {0} AS INTEGER)) AS w FROM network_events,
    (SELECT unnest(range({1} // {0})) AS k) AS shifts) GROUP BY ALL"""


@query("stream_rolling_kpi", KPI.format(15, 15, ""), "avg_network_quality data_usage avg_latency")
def _(t):
    events = stream_of(t, "network_events").withColumn("event_time", F.col("event_time").cast("timestamp"))
    return st.merge_kpi_partials(st.run_partials(events, out(t), st.kpi_partials))


@query("stream_rolling_kpi__sliding", KPI.format(15, 60, "region,"), "avg_network_quality data_usage avg_latency")
def _(t):
    events = stream_of(t, "network_events").withColumn("event_time", F.col("event_time").cast("timestamp"))
    log = st.run_partials(events, out(t), lambda b: st.kpi_partials(b, "1 hour", "15 minutes", ["region"]))
    return st.merge_kpi_partials(log, ["region"])


@query("stream_anomaly", f"""SELECT event_id FROM (SELECT event_id, abs(signal_strength - avg_signal) / nullif(signal_stddev, 0) AS a,
    abs(data_usage_mb - avg_usage) / nullif(usage_stddev, 0) AS b, abs(latency_ms - avg_latency) / nullif(latency_stddev, 0) AS c
    FROM network_events AS e JOIN ({BASE}) AS s ON s.device_type = e.device_type) WHERE a > 2 OR b > 2 OR c > 2""")
def _(t):
    baseline = an.baseline_stats(t.network_events, datasets.AS_OF_EVENTS)
    return run(t, st.stream_anomaly(stream_of(t, "network_events"), baseline, k=2.0)).select("event_id")


@query("stream_dedupe", "SELECT event_id FROM events")
def _(t):
    events = stream_of(t, "network_events")
    twice = events.unionByName(events).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return st.run_dedupe(twice, out(t), ["event_id"]).select("event_id")
