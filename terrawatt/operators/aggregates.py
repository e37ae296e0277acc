"""Grouped and global aggregations. All are declarative, so Spark combines map-side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_E = "energy_consumption"


def _meter_measures(suffix: str) -> list[Column]:
    return [
        F.sum(_E).alias(f"total_energy_{suffix}"),
        F.avg(_E).alias(f"avg_energy_{suffix}"),
        F.avg("voltage").alias(f"avg_voltage_{suffix}"),
        F.avg("current_reading").alias(f"avg_current_{suffix}"),
        F.max(_E).alias(f"max_consumption_{suffix}"),
        F.min(_E).alias(f"min_consumption_{suffix}"),
        F.count(F.lit(1)).alias(f"record_count_{suffix}"),
        F.sum("is_anomaly").alias(f"anomaly_count_{suffix}"),
    ]


def agg_meter_hourly(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("meter_id", "date", "hour", "partition_date")
        .agg(*_meter_measures("hourly"))
        .withColumn("aggregation_type", F.lit("HOURLY"))
    )


def agg_meter_daily(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("meter_id", "date", "partition_date")
        .agg(*_meter_measures("daily"), F.stddev_samp(_E).alias("std_energy_daily"))
        .withColumn("aggregation_type", F.lit("DAILY"))
    )


def agg_meter_summary(
    df: DataFrame, by: Sequence[str] = ("meter_id", "partition_date"), exact_days: bool = False
) -> DataFrame:
    """Meter totals; the active days are a sketch estimate unless `exact_days` asks for the count."""
    days = F.count_distinct("date") if exact_days else F.approx_count_distinct("date")
    return (
        df.groupBy(*by)
        .agg(
            F.sum(_E).alias("total_energy_meter"),
            F.avg(_E).alias("avg_energy_meter"),
            F.max(_E).alias("peak_consumption"),
            F.count(F.lit(1)).alias("total_readings"),
            days.alias("active_days"),
            F.sum("is_anomaly").alias("total_anomalies"),
        )
        .withColumn("aggregation_type", F.lit("METER_SUMMARY"))
    )


def agg_levels_rollup(df: DataFrame) -> DataFrame:
    """Hour, day and meter grains in one pass.

    The finest grain is aggregated first and the two coarser ones are folded from its rows, so the
    readings are read and shuffled once; grouping sets on the raw rows would triple them.
    """
    base = df.groupBy("meter_id", "date", "hour").agg(
        F.sum(_E).alias("s"),
        F.count(_E).alias("c"),
        F.max(_E).alias("mx"),
        F.min(_E).alias("mn"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("is_anomaly").alias("odd"),
    )
    levels = base.groupingSets(
        [
            [F.col("meter_id"), F.col("date"), F.col("hour")],
            [F.col("meter_id"), F.col("date")],
            [F.col("meter_id")],
        ],
        "meter_id",
        "date",
        "hour",
    ).agg(
        F.grouping_id().alias("_level"),
        F.sum("s").alias("total_energy"),
        F.try_divide(F.sum("s"), F.sum("c")).alias("avg_energy"),
        F.max("mx").alias("max_energy"),
        F.min("mn").alias("min_energy"),
        F.sum("rows").alias("n"),
        F.sum("odd").alias("anomalies"),
    )
    label = F.when(F.col("_level") == 0, "HOURLY").when(F.col("_level") == 1, "DAILY").otherwise("METER_SUMMARY")
    return levels.select(
        "meter_id", "date", "hour", label.alias("aggregation_type"), "total_energy", "avg_energy",
        "max_energy", "min_energy", "n", "anomalies",
    )


def agg_daily_energy_report(df: DataFrame) -> DataFrame:
    return df.groupBy("meter_id", "date").agg(
        F.sum(_E).alias("total_energy"),
        F.avg("voltage").alias("avg_voltage"),
        F.avg("current_reading").alias("avg_current"),
        F.max(_E).alias("max_consumption"),
        F.count(F.lit(1)).alias("record_count"),
    )


def agg_operator_region(df: DataFrame) -> DataFrame:
    return df.groupBy("operator", "region").agg(
        F.count(F.lit(1)).alias("equipment_count"),
        F.avg("cpu_usage").alias("avg_cpu_usage"),
        F.avg("network_throughput").alias("avg_throughput"),
        F.sum("active_connections").alias("total_connections"),
    )


def agg_daily_consumption_view(unified: DataFrame) -> DataFrame:
    return unified.groupBy(F.to_date("timestamp").alias("consumption_date"), "region", "data_source").agg(
        F.count_distinct("meter_id").alias("unique_meters"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("consumption_kwh").alias("total_energy_kwh"),
        F.avg("voltage").alias("avg_voltage"),
        F.avg("current_amps").alias("avg_current_amps"),
        F.max("consumption_kwh").alias("max_consumption_kwh"),
        F.count(F.lit(1)).alias("total_readings"),
    )


def agg_system_overview(unified: DataFrame) -> DataFrame:
    return unified.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("timestamp").alias("earliest_record"),
        F.max("timestamp").alias("latest_record"),
        F.count_distinct("meter_id").alias("unique_meters"),
        F.count_distinct("region").alias("unique_regions"),
    )


def agg_partial_states(df: DataFrame, grain: str = "hour", ts: str = "timestamp") -> DataFrame:
    """Mergeable state per meter and `grain`: sums and counts, never averages."""
    bucket = F.date_trunc(grain, F.col(ts)).cast("timestamp_ntz").alias("bucket")
    return df.groupBy("meter_id", bucket).agg(
        F.sum(_E).alias("sum_e"),
        F.count(_E).alias("cnt_e"),
        F.count(F.lit(1)).alias("n"),
        F.sum("is_anomaly").alias("anomalies"),
    )


def merge_partial_states(states: DataFrame, grain: str | None = None) -> DataFrame:
    """Fold states of any number of loads, optionally to a coarser grain."""
    bucket = F.col("bucket")
    if grain:
        bucket = F.date_trunc(grain, bucket).cast("timestamp_ntz")
    return states.groupBy("meter_id", bucket.alias("bucket")).agg(
        F.sum("sum_e").alias("total_energy"),
        F.try_divide(F.sum("sum_e"), F.sum("cnt_e")).alias("avg_energy"),
        F.sum("n").alias("readings_count"),
        F.sum("anomalies").alias("anomalies_count"),
    )


def agg_kpi_global(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row of named measures."""
    return df.agg(*[c.alias(n) for n, c in measures.items()])


agg_table_summary = agg_kpi_global


def agg_conditional_counts(df: DataFrame, predicates: Mapping[str, Column], total: str | None = None) -> DataFrame:
    """Rows that satisfy each predicate (NULL is not satisfied), in one scan."""
    measures = [F.count_if(p).alias(n) for n, p in predicates.items()]
    if total:
        measures.insert(0, F.count(F.lit(1)).alias(total))
    return df.agg(*measures)


def agg_distinct_count(df: DataFrame, columns: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Distinct non-null tuples."""
    return df.agg(F.count_distinct(*[F.col(c) for c in columns]).alias(name))


def agg_histogram_width_bucket(
    df: DataFrame, col: str, lo: float, hi: float, n: int, count_name: str = "count"
) -> DataFrame:
    """Equi-width buckets 1..n, underflow 0, overflow n + 1, and a group for NULL."""
    value = F.col(col)
    bucket = F.expr(f"width_bucket(`{col}`, {float(lo)}, {float(hi)}, {int(n)})")
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias(count_name),
        F.min(value).alias("bucket_min"),
        F.max(value).alias("bucket_max"),
    )


def agg_one_year_volume(tx: DataFrame, as_of: str, key: str = "community_id") -> DataFrame:
    """Sum and number of transactions since one year before `as_of`."""
    since = F.add_months(F.lit(as_of).cast("date"), -12)
    return tx.where(F.col("transaction_date") >= since).groupBy(key).agg(
        F.sum("price_aed").alias("transactions_volume_1y"),
        F.count(F.lit(1)).alias("transactions_count_1y"),
    )


def agg_price_per_area(tx: DataFrame, as_of: str) -> DataFrame:
    since = F.add_months(F.lit(as_of).cast("date"), -12)
    return tx.where(F.col("transaction_date") >= since).groupBy("community_id", "property_type").agg(
        F.count(F.lit(1)).alias("transactions_count"),
        F.avg(F.try_divide(F.col("price_aed"), F.col("area_m2"))).alias("avg_price_per_m2"),
    )


def agg_count_by_key(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def agg_invoice_total(lines: DataFrame) -> DataFrame:
    """Totals as DECIMAL(12, 2): quantities of three and prices of four decimals, exact line amounts, rounded once per invoice.

    Values beyond these types count as NULL, as do lines without quantity or price; a total beyond its type is NULL.
    """
    quantity, price = F.col("quantity").try_cast("decimal(12,3)"), F.col("unit_price").try_cast("decimal(12,4)")
    return lines.groupBy("invoice_id").agg(F.sum(quantity * price).try_cast("decimal(12,2)").alias("total_amount"))


def update_invoice_totals(invoices: DataFrame, lines: DataFrame, touched: DataFrame) -> DataFrame:
    """Recompute totals of the touched invoices only; the others keep theirs."""
    totals = agg_invoice_total(lines.join(touched, "invoice_id", "left_semi"))
    marked = touched.select("invoice_id").distinct().withColumn("_touched", F.lit(True))
    return (
        invoices.join(marked, "invoice_id", "left")
        .join(totals.withColumnRenamed("total_amount", "_new"), "invoice_id", "left")
        .withColumn("total_amount", F.when(F.col("_touched"), F.col("_new")).otherwise(F.col("total_amount")))
        .drop("_touched", "_new")
    )


def agg_reconciliation(billed: DataFrame, measured: DataFrame) -> DataFrame:
    """Billed against measured energy per customer and period; either side may be missing."""
    b = billed.groupBy("customer_id", "period").agg(F.sum("billed_kwh").alias("billed_kwh"))
    m = measured.groupBy("customer_id", "period").agg(F.sum("measured_kwh").alias("measured_kwh"))
    return b.join(m, ["customer_id", "period"], "full_outer").withColumn(
        "difference", F.col("measured_kwh") - F.col("billed_kwh")
    )


def agg_first_last(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records_count"),
        F.min(ts).alias("first_reading"),
        F.max(ts).alias("last_reading"),
    )


def agg_spatial_stats(df: DataFrame, area: Column, table: str) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("geom_count"),
        F.avg(area).alias("avg_area"),
    )
