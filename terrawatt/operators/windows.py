"""Shares, top-k, sampling and latest-row operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrawatt.operators.skew import first_per_key


def win_share_of_partition(df: DataFrame, value: str, by: str, name: str = "percentage") -> DataFrame:
    """value / sum(value) within `by`, as a fraction.

    The totals are aggregated map-side and joined back: a window over `by` would sort a whole
    group in one task. The join may broadcast the totals, or split skewed groups.
    """
    totals = df.groupBy(by).agg(F.sum(value).alias("_total"))
    a, t = df.alias("a"), totals.alias("t")
    return a.join(t, F.col(f"a.{by}").eqNullSafe(F.col(f"t.{by}")), "left").select(
        "a.*", F.try_divide(F.col(f"a.{value}"), F.col("t._total")).alias(name)
    )


def win_share_of_total(
    df: DataFrame, by: str, measures: Mapping[str, Column], share_of: str, name: str = "percentage"
) -> DataFrame:
    """Group, then divide one measure by its total over all groups, as a fraction.

    The total is a one-row scalar subquery; a window without keys would pull every group into
    one task. The subquery reads all measures, which keeps its grouping identical to the main one,
    so Spark scans and shuffles once and reuses the exchange.
    """
    groups = df.groupBy(by).agg(*[c.alias(n) for n, c in measures.items()])
    others = [F.count(n).alias(f"_{n}") for n in [by, *measures] if n != share_of]
    total = groups.agg(F.struct(F.sum(share_of).alias("total"), *others).alias("t")).scalar()["total"]
    return groups.withColumn(name, F.try_divide(F.col(share_of).cast("double"), total))


def win_row_number_random(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """`n` rows in a random but repeatable order, numbered from 1."""
    mixed = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))
    picked = df.withColumn("_mix", mixed).orderBy("_mix", key).limit(n)
    # At most n rows are left here, so a window without keys is harmless.
    return picked.withColumn("rn", F.row_number().over(W.orderBy("_mix", key))).drop("_mix")


def win_latest_per_key(df: DataFrame, key: str, ts: str, tie: str | None = None) -> DataFrame:
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return first_per_key(df, [key], order)


def topk_simple(df: DataFrame, order: Column | str, tie: str, k: int = 3, nulls_first: bool = True) -> DataFrame:
    """First `k` rows by descending `order`.

    NULL counts as the greatest value by default, as in PostgreSQL; `nulls_first=False` gives the
    order in which NULL is the least.
    """
    c = F.col(order) if isinstance(order, str) else order
    return df.orderBy(c.desc_nulls_first() if nulls_first else c.desc_nulls_last(), F.col(tie).asc()).limit(k)


def topk_after_group(df: DataFrame, by: str, measure: Column, name: str, k: int = 3) -> DataFrame:
    groups = df.groupBy(by).agg(measure.alias(name))
    return topk_simple(groups, name, by, k)


def topk_recent(df: DataFrame, ts: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)


def top_frequent_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("value").asc_nulls_first()).limit(k)


def sort_global(df: DataFrame, *columns: str) -> DataFrame:
    """Total order (range-partitioned, so it scales with the partitions)."""
    return df.orderBy(*columns)
