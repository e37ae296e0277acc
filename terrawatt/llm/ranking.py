"""Ranks over unbounded groups without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch

#: Buckets of the second level; one task sums at most so many counts of the first.
_FAN = 1024


def ranked(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Adds `out`: the rank (from 0, no gaps) by (bucket, order) within `keys`.

    `bucket` is a long that never decreases along the order. Rows are numbered inside (keys, bucket),
    and the numbers of rows in earlier buckets come from counts, summed in two levels: rows per bucket,
    then buckets per block of 1024. No task sees more than one bucket of rows or one level of counts.
    """
    marked = df.withColumn("_bucket", bucket).withColumn("_block", F.floor(F.col("_bucket") / _FAN))
    for i, k in enumerate(keys):  # groups may be null
        marked = marked.withColumn(f"_k{i}", F.struct(F.col(k)))
    own = [f"_k{i}" for i in range(len(keys))]
    counts = marked.groupBy(*own, "_block", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    blocks = counts.groupBy(*own, "_block").agg(F.sum("_n").alias("_n"))
    earlier = lambda part, by: F.coalesce(F.sum("_n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_before_block", earlier(own or [F.lit(1)], "_block")).drop("_n")
    counts = counts.withColumn("_before", earlier([*own, "_block"], "_bucket")).drop("_n")
    offsets = counts.join(blocks, [*own, "_block"]).select(*own, "_bucket", (F.col("_before") + F.col("_before_block")).alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*own, "_bucket").orderBy(*order))
    placed = marked.withColumn("_inner", inner).join(offsets, [*own, "_bucket"])
    return placed.withColumn(out, F.col("_before") + F.col("_inner") - 1).select(*df.columns, out)


def ranked_by_sort(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Adds `out`: the rank (from 0, no gaps) by `order`, nulls last, among rows of equal `key` (which may be null).

    Rows are sorted by range partitions, which cut through a large key wherever its `order` values
    differ. A row's rank is its place in its partition, less the place where its key starts there, plus the key's rows in earlier
    partitions: one count per key and partition.
    """
    scratch = Scratch(df.sparkSession, "ranked")
    by = [F.col(key), *[F.col(c).asc_nulls_last() for c in order]]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = scratch.keep(placed, "sorted").withColumn("_part", F.shiftright("_at", 33)).withColumn("_key", F.struct(key))
    starts = placed.groupBy("_key", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_key", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(starts, ["_key", "_part"]).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(out))
