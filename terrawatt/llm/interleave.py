"""Proportional stratified interleaving: shards whose mixture of sources matches the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.ranking import ranked
from terrawatt.llm.scratch import Scratch

#: Rows that one bucket of a distributed ranking holds on average.
BUCKET_ROWS = 512


def interleaved_shards(docs: DataFrame, shards: int, seed: str = "0", id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "source") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Rows of a stratum are shuffled by md5 of (seed, id, text checksum) and ranked; rank r of n gets
    the fraction (r - 1/2) / n. All rows, ordered by fraction, then stratum, are cut into runs whose
    row counts differ by at most one (law `rows`), so each shard holds each stratum in proportion,
    give or take one row per stratum. `size` is the UTF-8 length plus 16; a null text has length 0 and
    the checksum of no bytes. A null stratum is a stratum of its own. Equal rows are interchangeable.
    `grown_shard` is null: this law does not keep rows in place when a shard is added.
    """
    scratch = Scratch(docs.sparkSession, "interleave")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(stratum_col).alias("stratum"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    )
    shuffle = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("crc").cast("string")))
    rows = scratch.keep(rows.withColumn("draw", shuffle), "rows")
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    buckets = max(1, total // BUCKET_ROWS)
    # The first 8 hex digits are uniform, so each stratum spreads evenly over its share of the buckets.
    spread = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * buckets / F.lit(float(1 << 32))).cast("long")
    within = ranked(rows, ["stratum"], spread, [F.col("draw"), F.col("id"), F.col("crc"), F.col("size")], "r")
    # Strata are few against rows; the join is by value, and a null stratum must find itself.
    sized = within.join(sizes.withColumnRenamed("stratum", "s"), F.col("stratum").eqNullSafe(F.col("s"))).drop("s")
    sized = sized.withColumn("fraction", (F.col("r") * 2 + 1) / (F.col("n") * 2))
    sized = scratch.keep(sized.select("id", "stratum", "size", "crc", "draw", "fraction"), "fractions")
    scratch.drop("rows")
    spot = F.floor(F.col("fraction") * buckets).cast("long")
    order = [F.col("fraction"), F.col("stratum").asc_nulls_first(), F.col("draw"), F.col("id")]
    placed = ranked(sized, [], spot, order, "pos")
    shard = F.floor(F.expr(f"pos * {shards} div {max(total, 1)}"))
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        (F.col("pos") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
