"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex in `links` (a, b): the smallest vertex its links lead to.

    Each round links a vertex's larger neighbours to its smallest one, then its smaller neighbours
    too, until nothing changes; rounds grow with the logarithm of a component's size. Neighbours are
    never gathered: their minimum is aggregated before the shuffle and joined back, where adaptive
    execution splits hubs. Each round is written to the shared folder.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, k, seen = scratch.keep(edges, "0"), 0, None
    while True:
        mark = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(low, "u").select(F.inline(pair)).where("u <> v").distinct()
        k += 1
        edges = scratch.keep(small, str(k))
        scratch.drop(str(k - 1))
    own = edges.select(F.inline(F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("component")), F.struct(F.col("v").alias("id"), F.col("v").alias("component")))))
    return own.groupBy("id").agg(F.min("component").alias("component"))
