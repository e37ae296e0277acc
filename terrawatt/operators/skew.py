"""Building blocks that keep their balance when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by `order` (pass a unique last column to make it deterministic).

    `row_number() = 1` is planned with a per-task group limit before the shuffle, so a hot key
    sends one row per task across the network.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def next_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, bucket: Column, name: str
) -> DataFrame:
    """`lead(value)` over each key, without sorting a whole key in one task.

    `bucket` must not decrease along `order`; each (key, bucket) is sorted on its own, and the last
    row of a bucket takes the first value of the key's next bucket. Only one row per (key, bucket)
    is ever grouped by the key alone.
    """
    keyed = df.withColumn("_bucket", bucket).withColumn("_value", value)
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    # min over structs gives each bucket's first row in `order`.
    firsts = (
        keyed.groupBy(*keys, "_bucket")
        .agg(F.min(F.struct(*order, "_value"))["_value"].alias("_first"))
        .withColumn("_after", F.lead("_first").over(W.partitionBy(*keys).orderBy("_bucket")))
        .drop("_first")
    )
    # Keys may be NULL, so this join is null-safe.
    left = keyed.withColumn("_lead", F.lead("_value").over(inside)).alias("l")
    right = firsts.alias("r")
    on = F.lit(True)
    for k in [*keys, "_bucket"]:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, on, "left").select(
        *[F.col(f"l.{c}") for c in df.columns],
        F.coalesce(F.col("l._lead"), F.col("r._after")).alias(name),
    )


def balanced_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], rows_per_task: int = 1_000_000
) -> DataFrame:
    """Inner equi-join that splits keys with more than `rows_per_task` left rows.

    Hot keys are found by counting (map-side combined, at most rows / rows_per_task of them). Their
    left rows are spread over `n / rows_per_task` salts and the matching right rows are repeated
    once per salt; every other key keeps salt 0. The result equals the plain join.
    """
    hot = (
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_task)
        .select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted_left = left.join(hot, list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*left_id), salts.cast("long")).cast("int")
    ).drop("_salts")
    salted_right = right.join(hot, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    ).drop("_salts")
    return salted_left.join(salted_right, [*keys, "_salt"]).drop("_salt")


# Nested blocks over day numbers: level L has blocks of BLOCK_BASE**L days; level 5 spans 89 years.
BLOCK_BASE = 8
BLOCK_LEVELS = 6


def top_level(length: Column) -> Column:
    """The highest level whose blocks can lie within a range of `length` days."""
    level = F.floor(F.ln(F.greatest(length, F.lit(1)).cast("double")) / F.ln(F.lit(float(BLOCK_BASE))) + F.lit(1e-9))
    return F.least(level, F.lit(BLOCK_LEVELS)).cast("int")


def explode_blocks(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """One row per disjoint largest block (level, block) that makes up the integer range [lo, hi].

    On each level these are the blocks inside the range that no block of the next level covers.
    """
    width = F.pow(F.lit(float(BLOCK_BASE)), F.col("level"))
    leveled = df.withColumn("level", F.explode(F.sequence(F.lit(0), top_level(F.col(hi) - F.col(lo) + 1))))
    edges = leveled.withColumns(
        {
            # Blocks [_start, _stop) of this level lie inside the range; [_up, _down) of them lie
            # in a larger block that does too.
            "_start": F.ceil(F.col(lo) / width).cast("long"),
            "_stop": F.floor((F.col(hi) + 1) / width).cast("long"),
            "_up": F.ceil(F.col(lo) / (width * BLOCK_BASE)).cast("long") * BLOCK_BASE,
            "_down": F.floor((F.col(hi) + 1) / (width * BLOCK_BASE)).cast("long") * BLOCK_BASE,
        }
    )
    covered = (F.col("_up") < F.col("_down")) & (F.col("level") < BLOCK_LEVELS)
    upto = F.when(covered, F.col("_up")).otherwise(F.col("_stop"))
    since = F.when(covered, F.col("_down")).otherwise(F.col("_stop"))

    def run(first: Column, stop: Column) -> Column:
        # The filter below removes the element of an empty run.
        return F.sequence(first, F.greatest(first, stop - 1))

    blocks = F.array_union(run(F.col("_start"), upto), run(since, F.col("_stop")))
    inside = (F.col("block") < upto) | ((F.col("block") >= since) & (F.col("block") < F.col("_stop")))
    return (
        edges.withColumn("block", F.explode(blocks)).where(inside & (F.col("block") >= F.col("_start")))
        .drop("_start", "_stop", "_up", "_down")
    )


def block_of(point: Column, level: Column) -> Column:
    """The block of a level that holds an integer point."""
    return F.floor(point / F.pow(F.lit(float(BLOCK_BASE)), level)).cast("long")
