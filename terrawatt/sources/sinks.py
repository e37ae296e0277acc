"""Writers. All write from the executors; none collects rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawatt.session import scratch_path

# Frame name -> table name of the warehouse loader.
TABLE_NAMES = {
    "raw_data": "smart_meter_raw",
    "hourly_aggregates": "meter_aggregates",
    "daily_aggregates": "meter_aggregates",
    "meter_aggregates": "meter_aggregates",
}


#: Text formats cut times to milliseconds unless told otherwise.
FULL_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def route_table_name(frame: str, names: Mapping[str, str] = TABLE_NAMES) -> str:
    return names.get(frame, frame)


def sink_parquet_snappy(df: DataFrame, base: str, partition: str = "date", mode: str = "append") -> None:
    """Write into partition folders; `overwrite` replaces only the partitions present in `df`."""
    (
        df.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(base)
    )


def sink_jsonl_batches(df: DataFrame, path: str, per: int = 50_000, mode: str = "overwrite") -> None:
    """JSON lines in files of at most `per` rows, written by the tasks that compute the rows.

    The row limit is the writer's own, so the rows are neither counted nor dealt anew.
    """
    df.write.mode(mode).option("maxRecordsPerFile", per).option("ignoreNullFields", False).options(**FULL_TIMES).json(path)


def sink_multi_export(df: DataFrame, base: str, formats: Sequence[str] = ("parquet", "csv", "json")) -> None:
    """The same rows in several formats, computed once."""
    df.persist()
    try:
        for kind in formats:
            writer = df.write.mode("overwrite").format(kind)
            writer = writer if kind == "parquet" else writer.options(**FULL_TIMES)
            (writer.option("header", True) if kind == "csv" else writer).save(f"{base.rstrip('/')}/{kind}")
    finally:
        df.unpersist()


def jdbc_table_write(df: DataFrame, url: str, table: str, mode: str = "append", props: Mapping[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode, dict(props or {}))


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a table's content."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def mv_refresh(df: DataFrame, path: str) -> DataFrame:
    """Recompute a materialised result and return it as stored.

    The query may read the old content of `path`: rows are staged before the old files go.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "mv")
    df.write.parquet(staged)
    full_refresh(spark.read.parquet(staged), path)
    return spark.read.parquet(path)


def compact_partition(spark: SparkSession, path: str, n: int, sort: Sequence[str] = ()) -> None:
    """Rewrite a partition folder as `n` files, rows sorted for row-group skipping."""
    df = spark.read.parquet(path)
    packed = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort) if sort else df.repartition(n)
    mv_refresh(packed, path)


def etl_run_log(spark: SparkSession, source: str, partition: str, path: str, as_of: str | None = None) -> None:
    """Append (source, partition, loaded_at) to the run log."""
    at = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    row = spark.range(1).select(F.lit(source).alias("source_name"), F.lit(partition).alias("partition"), at.alias("loaded_at"))
    row.write.mode("append").parquet(path)
