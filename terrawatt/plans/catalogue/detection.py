"""Anomaly detectors and KPIs."""

from pyspark.sql import functions as F

from terrawatt.operators import anomaly as an
from terrawatt.plans.datasets import AS_OF_EVENTS
from terrawatt.plans.registry import query

AT = "TIMESTAMP '2024-01-31 00:00:00'"
HOURS = 72  # the test stream is sparse, so windows are wider than in production

BASE = """SELECT device_type, avg(signal_strength) AS avg_signal, stddev_pop(signal_strength) AS signal_stddev,
    avg(data_usage_mb) AS avg_usage, stddev_pop(data_usage_mb) AS usage_stddev, avg(latency_ms) AS avg_latency,
    stddev_pop(latency_ms) AS latency_stddev FROM network_events WHERE event_time >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY device_type"""
RECENT = f"SELECT * FROM network_events WHERE event_time >= {AT} - INTERVAL {HOURS} HOUR"


@query("baseline_stats", BASE, "avg_signal signal_stddev avg_usage usage_stddev avg_latency latency_stddev")
def _(t):
    return an.baseline_stats(t.network_events, AS_OF_EVENTS)


ZSCORE = f"""SELECT * FROM (SELECT device_id, event_time, 'z_score_outlier' AS anomaly_type,
    abs(signal_strength - avg_signal) / nullif(signal_stddev, 0) AS signal_z_score,
    abs(data_usage_mb - avg_usage) / nullif(usage_stddev, 0) AS usage_z_score,
    abs(latency_ms - avg_latency) / nullif(latency_stddev, 0) AS latency_z_score
    FROM ({RECENT}) AS e JOIN ({BASE}) AS b ON e.device_type = b.device_type)
    WHERE signal_z_score > 2 OR usage_z_score > 2 OR latency_z_score > 2"""


def zscore(t):
    return an.detect_zscore(t.network_events, an.baseline_stats(t.network_events, AS_OF_EVENTS), AS_OF_EVENTS, k=2.0, hours=HOURS)


@query("detect_zscore", ZSCORE, "signal_z_score usage_z_score latency_z_score")
def _(t):
    return zscore(t)


@query("join_stats_baseline", f"""SELECT event_id, e.device_type, avg_signal, signal_stddev FROM network_events AS e
    JOIN ({BASE}) AS b ON e.device_type = b.device_type""", "avg_signal signal_stddev")
def _(t):
    from terrawatt.operators.joins import join_stats_baseline

    joined = join_stats_baseline(t.network_events, an.baseline_stats(t.network_events, AS_OF_EVENTS))
    return joined.select("event_id", "device_type", "avg_signal", "signal_stddev")


VOLUME = f"""SELECT device_id, {AT} AS event_time, 'volume_anomaly' AS anomaly_type, n AS current_volume, avg_volume,
    n * 100.0 / avg_volume AS volume_percentage FROM (SELECT device_id, count(*) AS n,
      (SELECT avg(c) FROM (SELECT count(*) AS c FROM network_events WHERE event_time >= TIMESTAMP '2024-01-24 00:00:00'
       GROUP BY device_id, CAST(event_time AS DATE))) AS avg_volume FROM ({RECENT}) GROUP BY device_id) WHERE n > avg_volume * 2"""


def volume(t):
    return an.detect_volume(t.network_events, AS_OF_EVENTS, hours=HOURS)


@query("detect_volume", VOLUME, "avg_volume volume_percentage")
def _(t):
    return volume(t)


PERFORMANCE = f"""SELECT device_id, event_time, 'performance_degradation' AS anomaly_type, signal_strength, data_usage_mb, latency_ms,
    CASE WHEN signal_strength < 10 THEN 'CRITICAL' WHEN signal_strength < 20 THEN 'HIGH' WHEN latency_ms > 500 THEN 'HIGH'
    ELSE 'MEDIUM' END AS severity FROM ({RECENT}) WHERE signal_strength < 20 OR latency_ms > 300 OR data_usage_mb > 1000"""


def performance(t):
    return an.detect_performance(t.network_events, AS_OF_EVENTS, hours=HOURS)


@query("detect_performance", PERFORMANCE, "signal_strength data_usage_mb latency_ms")
def _(t):
    return performance(t)


GEOGRAPHIC = f"""SELECT concat('REGION_', region) AS device_id, {AT} AS event_time, 'geographic_anomaly' AS anomaly_type, avg_signal,
    total_events, avg_signal * 100.0 / o AS signal_percentage FROM (SELECT region, avg(signal_strength) AS avg_signal,
    count(*) AS total_events, (SELECT avg(signal_strength) FROM ({RECENT})) AS o FROM ({RECENT}) GROUP BY region)
    WHERE avg_signal < o * 0.99"""


def geographic(t):
    return an.detect_geographic(t.network_events, AS_OF_EVENTS, factor=0.99, hours=HOURS)


@query("detect_geographic", GEOGRAPHIC, "avg_signal signal_percentage")
def _(t):
    return geographic(t)


def _long(sql: str, metrics: dict[str, str], severity: str = "NULL") -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST(device_id AS VARCHAR) AS entity, event_time, anomaly_type, {severity} AS severity,
        '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM ({sql})""" for m, c in metrics.items()
    )


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


UNION = " UNION ALL ".join([
    _long(ZSCORE, _same("signal_z_score", "usage_z_score", "latency_z_score")),
    _long(VOLUME, _same("current_volume", "avg_volume", "volume_percentage")),
    _long(PERFORMANCE, _same("signal_strength", "data_usage_mb", "latency_ms"), "severity"),
    _long(GEOGRAPHIC, _same("avg_signal", "total_events", "signal_percentage")),
])


def detected(t):
    return an.detected_anomalies_union([zscore(t), volume(t), performance(t), geographic(t)], AS_OF_EVENTS)


@query("detected_anomalies_union", UNION, "value")
def _(t):
    return detected(t).select("entity", "event_time", "anomaly_type", "severity", F.explode("metrics").alias("metric", "value"))


@query("anomaly_summary", f"""SELECT anomaly_type, count(*) AS anomalies, count(*) > 10 AS alert FROM (
    SELECT anomaly_type FROM ({ZSCORE}) UNION ALL SELECT anomaly_type FROM ({VOLUME}) UNION ALL
    SELECT anomaly_type FROM ({PERFORMANCE}) UNION ALL SELECT anomaly_type FROM ({GEOGRAPHIC})) GROUP BY 1""")
def _(t):
    return an.anomaly_summary(detected(t), alert_over=10)


@query("anomaly_iqr", """SELECT event_id, value FROM events, (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
    FROM events) WHERE value < q1 - 0.5 * (q3 - q1) OR value > q3 + 0.5 * (q3 - q1)""", "value")
def _(t):
    return an.anomaly_iqr(t.events, "value", k=0.5).select("event_id", "value")


@query("kpi_realtime", f"""SELECT avg(signal_strength) AS avg_network_quality, count(DISTINCT device_id) AS active_devices,
    sum(data_usage_mb) AS data_usage, avg(latency_ms) AS avg_latency FROM ({RECENT})""", "avg_network_quality data_usage avg_latency")
def _(t):
    return an.kpi_realtime(t.network_events, AS_OF_EVENTS, minutes=HOURS * 60)


@query("kpi_geo_heatmap", f"""SELECT region, count(*) AS event_count, avg(signal_strength) AS signal_quality
    FROM ({RECENT}) GROUP BY region""", "signal_quality")
def _(t):
    return an.kpi_geo_heatmap(t.network_events, AS_OF_EVENTS, hours=HOURS)


@query("join_region_scalar", """SELECT region, avg_signal, (SELECT avg(signal_strength) FROM network_events) AS overall_avg_signal
    FROM (SELECT region, avg(signal_strength) AS avg_signal FROM network_events GROUP BY region)""", "avg_signal overall_avg_signal")
def _(t):
    from terrawatt.operators.joins import join_region_scalar

    groups = t.network_events.groupBy("region").agg(F.avg("signal_strength").alias("avg_signal"))
    return join_region_scalar(groups, t.network_events, F.avg("signal_strength"), "overall_avg_signal")
