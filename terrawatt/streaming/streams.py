"""Streaming twins: each takes a streaming DataFrame and returns one, unless it says otherwise."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.operators.anomaly import METRICS, z_scores
from terrawatt.operators.changes import cdc_parse_debezium, merge_upsert, parse_producer
from terrawatt.operators.skew import first_per_key
from terrawatt.session import scratch_path
from terrawatt.sources.scans import parse_json_values


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, standing in for a topic."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic's values (the Kafka connector must be installed)."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest").load()
    )


def stream_kafka_json(sdf: DataFrame, schema: T.StructType | str | None = None, value: str = "payload") -> DataFrame:
    """Typed producer rows, or any schema given."""
    return parse_producer(sdf, value) if schema is None else parse_json_values(sdf, schema, value)


def stream_cdc_json(sdf: DataFrame, value: str = "payload") -> DataFrame:
    return cdc_parse_debezium(sdf, value)


def stream_incremental_agg(sdf: DataFrame, grain: str = "1 hour", watermark: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """Running state per meter and time bucket: use update mode and keep the latest row per key.

    Rows later than the watermark are dropped; `run_partials` with `meter_partials` keeps them.
    """
    return (
        sdf.withWatermark(ts, watermark).groupBy(F.window(ts, grain).alias("w"), "meter_id")
        .agg(
            F.sum("energy_consumption").alias("sum_e"), F.count("energy_consumption").alias("cnt_e"),
            F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").alias("anomalies"),
        )
        .select("meter_id", F.col("w.start").cast("timestamp_ntz").alias("bucket"), "sum_e", "cnt_e", "n", "anomalies")
    )


def stream_rolling_kpi(sdf: DataFrame, window: str = "15 minutes", slide: str | None = None, watermark: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """Network KPIs per tumbling or sliding window.

    Active devices are an approximate distinct count, as streaming aggregation requires. Rows later
    than the watermark are dropped; `run_partials` with `kpi_partials` keeps them.
    """
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return (
        sdf.withWatermark("event_time", watermark).groupBy(w.alias("w"), *by)
        .agg(
            F.avg("signal_strength").alias("avg_network_quality"), F.approx_count_distinct("device_id", 0.01).alias("active_devices"),
            F.sum("data_usage_mb").alias("data_usage"), F.avg("latency_ms").alias("avg_latency"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                *by, "avg_network_quality", "active_devices", "data_usage", "avg_latency", "event_count")
    )


def stream_anomaly(sdf: DataFrame, baseline: DataFrame, k: float = 3.0) -> DataFrame:
    """Events beyond `k` deviations of a static baseline."""
    outlier = F.lit(False)
    for n in METRICS:
        outlier = outlier | F.coalesce(F.col(f"{n}_z_score") > k, F.lit(False))
    return z_scores(sdf, baseline).where(outlier)


def stream_dedupe(sdf: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeats that arrive within the delay; state older than that is released, and rows later than
    the watermark are dropped. `run_dedupe` keeps them."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# --- partial results by micro-batch -----------------------------------------------------
#
# A watermark drops what comes after it, so its results depend on how rows fall into batches. The
# forms below keep every row: each micro-batch is aggregated on its own, the partial results are
# stored by batch, and merging them gives what one batch over all rows would.


def meter_partials(batch: DataFrame, grain: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """Sums and counts of one micro-batch per meter and time bucket."""
    return (
        batch.groupBy(F.window(ts, grain).alias("w"), "meter_id")
        .agg(
            F.sum("energy_consumption").alias("sum_e"), F.count("energy_consumption").alias("cnt_e"),
            F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").alias("anomalies"),
        )
        .select("meter_id", F.col("w.start").cast("timestamp_ntz").alias("bucket"), "sum_e", "cnt_e", "n", "anomalies")
    )


def merge_meter_partials(log: DataFrame) -> DataFrame:
    return log.groupBy("meter_id", "bucket").agg(*[F.sum(c).alias(c) for c in ("sum_e", "cnt_e", "n", "anomalies")])


_KPI_SUMS = {"s_signal": "signal_strength", "s_usage": "data_usage_mb", "s_latency": "latency_ms"}


def kpi_partials(batch: DataFrame, window: str = "15 minutes", slide: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Sums and counts of one micro-batch per window, group and device; devices can be counted exactly later."""
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    sums = [F.sum(c).alias(s) for s, c in _KPI_SUMS.items()]
    counts = [F.count(c).alias(f"n{s}") for s, c in _KPI_SUMS.items()]
    kept = batch.groupBy(w.alias("w"), *by, "device_id").agg(*sums, *counts, F.count(F.lit(1)).alias("n"))
    return kept.withColumns({"window_start": F.col("w.start").cast("timestamp_ntz"), "window_end": F.col("w.end").cast("timestamp_ntz")}).drop("w")


def merge_kpi_partials(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """KPIs per window from all partials: devices are folded first, so counting them is counting rows."""
    keys, sums = ["window_start", "window_end", *by], [*_KPI_SUMS, *(f"n{s}" for s in _KPI_SUMS), "n"]
    devices = log.groupBy(*keys, "device_id").agg(*[F.sum(c).alias(c) for c in sums])
    whole = devices.groupBy(*keys).agg(F.count("device_id").alias("active_devices"), *[F.sum(c).alias(c) for c in sums])
    mean = lambda s: F.try_divide(F.col(s), F.col(f"n{s}"))
    return whole.select(
        *keys, mean("s_signal").alias("avg_network_quality"), "active_devices", F.col("s_usage").alias("data_usage"),
        mean("s_latency").alias("avg_latency"), F.col("n").alias("event_count"),
    )


def run_partials(sdf: DataFrame, path: str, partial: Callable[[DataFrame], DataFrame], checkpoint: str | None = None) -> DataFrame:
    """Process everything available; each micro-batch stores `partial` of its rows under its own epoch.

    A repeated batch overwrites its own result. Returns the stored partials of all batches.
    """
    spark = sdf.sparkSession
    empty = spark.createDataFrame([], sdf.schema)
    schema = T.StructType([*partial(empty).schema.fields, T.StructField("epoch", T.LongType())])

    def write(batch: DataFrame, epoch: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    sdf.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(schema).parquet(path)


def run_dedupe(sdf: DataFrame, path: str, keys: Sequence[str], checkpoint: str | None = None) -> DataFrame:
    """Process everything available and keep the first row of each key, however late its repeats come.

    A micro-batch drops its own repeats and what earlier batches have stored; a repeated batch looks
    only at the batches before it and overwrites its own rows. Keys may be null.
    """
    spark = sdf.sparkSession
    schema = T.StructType([*sdf.schema.fields, T.StructField("epoch", T.LongType())])

    def write(batch: DataFrame, epoch: int) -> None:
        fresh = batch.dropDuplicates(list(keys))
        if epoch:
            known = spark.read.schema(schema).parquet(path).where(F.col("epoch") < epoch).select(*[F.col(k).alias(f"_known_{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
            fresh = fresh.join(known, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    sdf.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(schema).parquet(path).drop("epoch")


# --- running streams --------------------------------------------------------------------


def run_to_table(sdf: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process everything available, then return the stored rows.

    Append mode uses the exactly-once file sink. Update mode keeps a change log of revisions: each
    micro-batch overwrites its own `epoch=` folder, so a repeated batch cannot double its rows.
    """
    spark = sdf.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    writer = sdf.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if mode == "append":
        writer = writer.format("parquet").option("path", path).outputMode("append")
    else:
        writer = writer.outputMode(mode).foreachBatch(_epoch_writer(path))
    query = writer.start()
    query.awaitTermination()
    return spark.read.schema(_stored_schema(sdf, mode)).parquet(path)


def _stored_schema(sdf: DataFrame, mode: str) -> T.StructType:
    fields = list(sdf.schema.fields)
    return T.StructType(fields if mode == "append" else [*fields, T.StructField("epoch", T.LongType())])


def _epoch_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def latest_revision(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows of an update-mode change log."""
    return first_per_key(log, keys, [F.col("epoch").desc()]).drop("epoch")


def upsert_batches(path: str, keys: Sequence[str], order: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that keeps one current row per key under versioned folders.

    Batch e reads version e - 1 and writes version e, so a retry rebuilds the same version. Every
    batch rewrites the table: for a large one keep the revision log of `run_to_table` instead.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch == 0:
            merged = first_per_key(batch, keys, [F.col(order).desc()])
        else:
            merged = merge_upsert(spark.read.parquet(f"{path}/v{epoch - 1}"), batch, keys, [F.col(order).desc()])
        merged.write.mode("overwrite").parquet(f"{path}/v{epoch}")

    return apply
