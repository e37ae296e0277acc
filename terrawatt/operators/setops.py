"""Unions of sources, edges and key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.operators.changes import CDC_SOURCE, KEPT_OPERATIONS, PRODUCER_SOURCE


def union_all_unified_sources(cdc: DataFrame, producer: DataFrame) -> DataFrame:
    """Change rows and producer rows as one 15-column frame; what a source lacks is NULL."""
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    changed = cdc.where(F.col("cdc_operation").isin(*KEPT_OPERATIONS)).select(
        "meter_id", "timestamp", none("string", "region"), none("string", "customer_id"),
        F.col("energy_consumption").alias("consumption_kwh"), "voltage",
        F.col("current_reading").alias("current_amps"), "power_factor", "frequency", "status",
        F.col("id").alias("cdc_id"), "created_at", "updated_at",
        F.lit(CDC_SOURCE).alias("data_source"), F.col("cdc_operation").alias("operation_type"),
    )
    produced = producer.select(
        "meter_id", "timestamp", "region", "customer_id",
        F.col("kwh_usage").alias("consumption_kwh"), F.col("voltage").cast("decimal(18,2)").alias("voltage"),
        none("decimal(18,2)", "current_amps"), none("decimal(18,3)", "power_factor"),
        none("decimal(18,2)", "frequency"), F.lit("active").alias("status"), none("bigint", "cdc_id"),
        F.col("timestamp").alias("created_at"), F.col("timestamp").alias("updated_at"),
        F.lit(PRODUCER_SOURCE).alias("data_source"), F.lit("c").alias("operation_type"),
    )
    return changed.unionByName(produced)


def union_all_edges_reverse(edges: DataFrame, two_way: Column) -> DataFrame:
    """Edges plus the reverse of the two-way ones, from one scan."""
    both = F.array(
        F.struct(F.col("from_node").alias("f"), F.col("to_node").alias("t")),
        F.struct(F.col("to_node").alias("f"), F.col("from_node").alias("t")),
    )
    rest = [c for c in edges.columns if c not in ("from_node", "to_node")]
    directions = F.when(two_way, both).otherwise(F.slice(both, 1, 1))
    return edges.withColumn("_d", F.explode(directions)).select(
        F.col("_d.f").alias("from_node"), F.col("_d.t").alias("to_node"), *rest
    )


def union_distinct_touched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def union_all_literals(df: DataFrame, expected_rows: int) -> DataFrame:
    """Expected against actual row count, as two labelled rows."""
    spark = df.sparkSession
    expected = spark.createDataFrame([("Expected", expected_rows)], "description string, records long")
    actual = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit("Actual").alias("description"), "records")
    return expected.unionByName(actual)


def missing_ids(df: DataFrame, expected: Sequence[str], key: str) -> DataFrame:
    """Expected ids that the data lacks."""
    wanted = df.sparkSession.createDataFrame([(e,) for e in expected], f"{key} string")
    return wanted.join(df.select(key).distinct(), key, "left_anti")
