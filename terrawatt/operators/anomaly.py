"""Anomaly detectors and KPIs over network events. `as_of` stands for the current time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.functions.scalar import percent
from terrawatt.operators.quality import _since

METRICS = {"signal": "signal_strength", "usage": "data_usage_mb", "latency": "latency_ms"}


def _at(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _since_day(df: DataFrame, as_of: str, days: int) -> DataFrame:
    """Rows from the start of the day `days` days before `as_of`."""
    first = F.date_sub(_at(as_of).cast("date"), days).cast("timestamp_ntz")
    return df.where(F.col("event_time") >= first)


def baseline_stats(df: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Mean and population deviation of each metric per device type."""
    return _since_day(df, as_of, days).groupBy("device_type").agg(
        *[c for n, m in METRICS.items() for c in (F.avg(m).alias(f"avg_{n}"), F.stddev_pop(m).alias(f"{n}_stddev"))]
    )


def z_scores(events: DataFrame, baseline: DataFrame) -> DataFrame:
    """Events with their distance from the baseline in deviations; NULL when the deviation is 0."""
    joined = events.join(baseline, "device_type")
    scores = {
        f"{n}_z_score": F.try_divide(F.abs(F.col(m) - F.col(f"avg_{n}")), F.nullif(F.col(f"{n}_stddev"), F.lit(0.0)))
        for n, m in METRICS.items()
    }
    return joined.select(*events.columns, *[c.alias(n) for n, c in scores.items()])


def detect_zscore(df: DataFrame, baseline: DataFrame, as_of: str, k: float = 3.0, hours: float = 2) -> DataFrame:
    scored = z_scores(_since(df, "event_time", as_of, hours), baseline)
    outlier = F.lit(False)
    for n in METRICS:
        outlier = outlier | F.coalesce(F.col(f"{n}_z_score") > k, F.lit(False))
    return scored.where(outlier).select(
        "device_id", "event_time", F.lit("z_score_outlier").alias("anomaly_type"),
        *[f"{n}_z_score" for n in METRICS],
    )


def detect_volume(df: DataFrame, as_of: str, factor: float = 2, hours: float = 1, days: int = 7) -> DataFrame:
    """Devices whose recent count exceeds `factor` times the mean count per device and day."""
    daily = _since_day(df, as_of, days).groupBy("device_id", F.to_date("event_time").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    mean = daily.agg(F.avg("n")).scalar()
    recent = _since(df, "event_time", as_of, hours).groupBy("device_id").agg(F.count(F.lit(1)).alias("current_volume"))
    return (
        recent.withColumn("avg_volume", mean)
        .where(F.col("current_volume") > F.col("avg_volume") * factor)
        .select(
            "device_id", _at(as_of).alias("event_time"), F.lit("volume_anomaly").alias("anomaly_type"),
            "current_volume", "avg_volume",
            percent(F.col("current_volume"), F.col("avg_volume")).alias("volume_percentage"),
        )
    )


def detect_performance(
    df: DataFrame, as_of: str, hours: float = 1, signal: float = 20, latency: float = 300, usage: float = 1000
) -> DataFrame:
    s, l, u = F.col("signal_strength"), F.col("latency_ms"), F.col("data_usage_mb")
    severity = F.when(s < 10, "CRITICAL").when(s < 20, "HIGH").when(l > 500, "HIGH").otherwise("MEDIUM")
    return _since(df, "event_time", as_of, hours).where((s < signal) | (l > latency) | (u > usage)).select(
        "device_id", "event_time", F.lit("performance_degradation").alias("anomaly_type"),
        "signal_strength", "data_usage_mb", "latency_ms", severity.alias("severity"),
    )


def detect_geographic(df: DataFrame, as_of: str, factor: float = 0.7, hours: float = 1) -> DataFrame:
    """Regions whose mean signal is below `factor` times the overall mean."""
    recent = _since(df, "event_time", as_of, hours)
    # One scan: the overall mean is folded from the per-region sums.
    regions = recent.groupBy("region").agg(
        F.sum("signal_strength").alias("_s"), F.count("signal_strength").alias("_c"),
        F.count(F.lit(1)).alias("total_events"),
    )
    overall = regions.agg(F.try_divide(F.sum("_s"), F.sum("_c"))).scalar()
    return (
        regions.withColumn("avg_signal", F.try_divide(F.col("_s"), F.col("_c")))
        .withColumn("overall_avg_signal", overall)
        .where(F.col("avg_signal") < F.col("overall_avg_signal") * factor)
        .select(
            F.concat(F.lit("REGION_"), F.col("region")).alias("device_id"),
            _at(as_of).alias("event_time"), F.lit("geographic_anomaly").alias("anomaly_type"),
            "avg_signal", "total_events",
            percent(F.col("avg_signal"), F.col("overall_avg_signal")).alias("signal_percentage"),
        )
    )


def detected_anomalies_union(frames: Sequence[DataFrame], as_of: str) -> DataFrame:
    """All detectors in one schema: entity, time, type, severity and a map of named metrics."""
    fixed = ("device_id", "event_time", "anomaly_type", "severity")
    out = None
    for df in frames:
        metrics = [c for c in df.columns if c not in fixed]
        packed = F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))])
        rows = df.select(
            F.col("device_id").cast("string").alias("entity"), "event_time", "anomaly_type",
            (F.col("severity") if "severity" in df.columns else F.lit(None).cast("string")).alias("severity"),
            packed.alias("metrics"), _at(as_of).alias("detected_at"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def anomaly_summary(anomalies: DataFrame, alert_over: int = 0) -> DataFrame:
    counts = anomalies.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("anomalies"))
    return counts.withColumn("alert", F.col("anomalies") > alert_over)


def anomaly_iqr(df: DataFrame, col: str, k: float = 1.5, accuracy: int = 100_000) -> DataFrame:
    """Rows outside the quartiles by more than `k` interquartile ranges.

    Quartiles come from a bounded-memory sketch with rank error 1 / accuracy.
    """
    q = df.agg(F.percentile_approx(col, [0.25, 0.75], accuracy).alias("q")).scalar()
    spread = q[1] - q[0]
    low, high = q[0] - F.lit(k) * spread, q[1] + F.lit(k) * spread
    return df.where((F.col(col) < low) | (F.col(col) > high))


def kpi_realtime(df: DataFrame, as_of: str, minutes: float = 15) -> DataFrame:
    return _since(df, "event_time", as_of, minutes / 60).agg(
        F.avg("signal_strength").alias("avg_network_quality"),
        F.count_distinct("device_id").alias("active_devices"),
        F.sum("data_usage_mb").alias("data_usage"),
        F.avg("latency_ms").alias("avg_latency"),
    )


def kpi_geo_heatmap(df: DataFrame, as_of: str, hours: float = 1) -> DataFrame:
    return _since(df, "event_time", as_of, hours).groupBy("region").agg(
        F.count(F.lit(1)).alias("event_count"), F.avg("signal_strength").alias("signal_quality")
    )
