"""Relational joins. Sides are never force-broadcast: Spark picks by size, AQE corrects at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.operators.skew import first_per_key


def join_inner_equi(left: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    for dim, key in dims:
        left = left.join(dim, key, "inner")
    return left


def join_left_star(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left-join dimensions one after the other; `dims` is name -> (frame, key column)."""
    for dim, key in dims.values():
        fact = fact.join(dim, key, "left")
    return fact


def join_on_true_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row, as a scalar subquery."""
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("_row")).scalar()
    return df.select("*", *[packed[n].alias(n) for n in names])


def join_on_true_fanout(df: DataFrame, small: DataFrame) -> DataFrame:
    """Every row of `df` with every row of an aggregate that has a known, small number of groups; rows
    survive an empty one."""
    return df.join(small, F.lit(True), "left")


def join_multi_child_fanout(parent: DataFrame, key: str, children: Sequence[DataFrame]) -> DataFrame:
    """Parent with all combinations of its children: the product per key is the intended result."""
    for child in children:
        parent = parent.join(child, key, "left")
    return parent


def join_on_json_key(features: DataFrame, other: DataFrame, path: str, key: str, payload: str = "payload") -> DataFrame:
    """Equi-join on a value inside a JSON column, extracted once before the shuffle."""
    return features.withColumn(key, F.get_json_object(F.col(payload), path)).join(other, key)


def join_multi_key_const(entities: DataFrame, features: DataFrame, entity_type: str = "BUILDING") -> DataFrame:
    """Entities with their long-format features; the constant key filters before the join."""
    wanted = features.where(F.col("entity_type") == entity_type)
    return entities.join(wanted, entities["building_id"] == wanted["entity_id"]).select(
        "building_id", "feature_name", "feature_value", "computed_at"
    )


def join_full_outer_changes(inserted: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Label keys that occur in the new rows, the old rows, or both."""
    i = inserted.select(F.col(key), F.lit(True).alias("_i"))
    d = deleted.select(F.col(key), F.lit(True).alias("_d"))
    label = (
        F.when(F.col("_i") & F.col("_d"), "UPDATE").when(F.col("_i"), "INSERT").otherwise("DELETE")
    )
    return i.join(d, key, "full_outer").select(key, label.alias("operation"))


def semi_in_subquery(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def anti_conflict_do_nothing(target: DataFrame, rows: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Append only rows with new keys; of several new rows with one key the first by `order` (by all columns) is kept."""
    fresh = first_per_key(rows.join(target, key, "left_anti"), [key], [F.col(c) for c in order or rows.columns])
    return target.unionByName(fresh)


def join_stats_baseline(events: DataFrame, baseline: DataFrame, key: str = "device_type") -> DataFrame:
    return events.join(baseline, key)


def join_region_scalar(groups: DataFrame, rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Attach one overall aggregate of `rows` to every group."""
    return groups.withColumn(name, rows.agg(value).scalar())


def lateral_scalar_lookup(df: DataFrame, lookup: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """Correlated per-row lookups as one left join (`lookup` has one row per key)."""
    values = lookup.select(key, *[c.alias(n) for n, c in columns.items()])
    return df.join(values, key, "left")


def join_geometry_equality(segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Match the two ends of each segment to nodes with the same coordinates.

    `segments`: road_id, x1, y1, x2, y2; `nodes`: node_id, lon, lat. Node duplicates fan out.
    """
    start = nodes.select(F.col("node_id").alias("from_node"), F.col("lon").alias("x1"), F.col("lat").alias("y1"))
    end = nodes.select(F.col("node_id").alias("to_node"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    return segments.join(start, ["x1", "y1"]).join(end, ["x2", "y2"])
