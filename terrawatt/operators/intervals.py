"""Validity intervals: active contracts, as-of tariffs, overlaps, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrawatt.operators.skew import block_of, explode_blocks, first_per_key, next_in_group, top_level


def _day(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of.cast("date")


def _open_at(end: Column, as_of: str | Column) -> Column:
    return end.isNull() | (end >= _day(as_of))


def semi_active_contract(
    customers: DataFrame, contracts: DataFrame, as_of: str, check_end_date: bool = True
) -> DataFrame:
    """Whether each customer has an active contract, optionally one that has not ended."""
    active = contracts.where(F.col("status") == "Active")
    if check_end_date:
        active = active.where(_open_at(F.col("end_date"), as_of))
    flags = active.select("customer_id").distinct().withColumn("_has", F.lit(True))
    return customers.join(flags, "customer_id", "left").select(
        "customer_id", F.coalesce("_has", F.lit(False)).alias("has_active")
    )


def interval_active_meters(meters: DataFrame, as_of: str) -> DataFrame:
    return meters.where(_open_at(F.col("end_date"), as_of)).select(
        "customer_id", "meter_id", "start_date", "end_date"
    )


def asof_active_tariff(contracts: DataFrame, assignments: DataFrame, as_of: str) -> DataFrame:
    """Per customer, the latest tariff in force at `as_of` (ties: the greatest assignment id)."""
    in_force = assignments.where(
        (F.col("effective_from") <= _day(as_of)) & _open_at(F.col("effective_to"), as_of)
    ).select("contract_id", "assignment_id", "tariff_id", "effective_from")
    active = contracts.where(F.col("status") == "Active").select("contract_id", "customer_id")
    rows = active.join(in_force, "contract_id")
    latest = first_per_key(rows, ["customer_id"], [F.col("effective_from").desc(), F.col("assignment_id").desc()])
    return latest.select("customer_id", "tariff_id")


def cross_apply_tariff_lines(
    invoices: DataFrame, tariffs: DataFrame, rates: DataFrame, tou: int = 1
) -> DataFrame:
    """One generated line per invoice and matching rate of the customer's tariff; quantity starts at 0."""
    wanted = rates.where(F.col("tou_code_id") == tou).select("tariff_id", "price_per_kwh")
    return (
        invoices.select("invoice_id", "customer_id")
        .join(tariffs, "customer_id")
        .join(wanted, "tariff_id")
        .select(
            "invoice_id",
            F.lit("Energy Consumption").alias("description"),
            F.lit(0).alias("quantity"),
            F.col("price_per_kwh").alias("unit_price"),
        )
    )


def interval_overlap_check(
    assignments: DataFrame,
    key: str = "contract_id",
    row_id: str = "assignment_id",
    start: str = "effective_from",
    end: str = "effective_to",
    strict: bool = False,
    direct_limit: int = 64,
) -> DataFrame:
    """Pairs (a, b) of one key where an end point of a lies within b.

    With `strict=False` an open end never matches (a comparison with NULL is unknown) and a range
    that encloses the other without an end point inside is reported from the enclosed side only.
    `strict=True` reports each truly overlapping pair once, a_id < b_id, open ends included.

    Keys with at most `direct_limit` ranges are joined with themselves. The ranges of larger keys
    are split into nested day blocks and matched to points by block: only true matches meet, and
    the key spreads over its blocks.
    """
    rows = assignments.select(
        F.col(key).alias("k"), F.col(row_id).alias("i"), F.col(start).alias("s"), F.col(end).alias("e")
    ).where(F.col("k").isNotNull())
    large = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > direct_limit).select("k")
    direct = _overlaps_direct(rows.join(large, "k", "left_anti"), strict)
    blocked = _overlaps_blocked(rows.join(large, "k", "left_semi"), strict)
    return direct.unionByName(blocked).withColumnRenamed("k", key)


def interval_overlap_exists(
    assignments: DataFrame,
    key: str = "contract_id",
    start: str = "effective_from",
    end: str = "effective_to",
    strict: bool = False,
) -> DataFrame:
    """(key, first_overlap): the keys with at least one overlapping pair, and the earliest start that falls into an earlier range.

    No pair is formed: ordered by start, a range overlaps an earlier one exactly if it starts no later than the
    greatest end so far. That maximum is a distributed prefix maximum: ranges are folded by (key, start),
    months of a key are summed up, and each month then only needs its own rows and the maximum before
    it, so a key with a large part of all rows is spread over its months. An open end overlaps nothing that starts later
    unless `strict`. Rows without key or start and ranges that end before they start take no part.
    """
    rows = assignments.select(F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e"))
    rows = rows.where(F.col("k").isNotNull() & F.col("s").isNotNull() & (F.col("e").isNull() | (F.col("e") >= F.col("s"))))
    folded = rows.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"), F.count("e").alias("closed"), F.max("e").alias("last"))
    folded = folded.withColumn("block", F.year("s") * 12 + F.month("s")).withColumn("open", F.col("closed") < F.col("n"))
    earlier = lambda c, *by: F.max(c).over(W.partitionBy("k", *by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1))
    blocks = folded.groupBy("k", "block").agg(F.max("last").alias("last"), F.max("open").alias("open"))
    blocks = blocks.select("k", "block", earlier("last", "block").alias("last_before"), earlier("open", "block").alias("open_before"))
    inside = folded.withColumn("last_here", earlier("last", "block", "s")).withColumn("open_here", earlier("open", "block", "s")).join(blocks, ["k", "block"])
    hit = (F.col("n") > 1) & ((F.col("closed") > 0) | F.lit(strict))
    hit = hit | (F.col("s") <= F.greatest("last_here", "last_before"))
    if strict:
        hit = hit | F.col("open_here") | F.col("open_before")
    return inside.where(F.coalesce(hit, F.lit(False))).groupBy(F.col("k").alias(key)).agg(F.min("s").alias("first_overlap"))


_NO_END = "9999-12-31"  # stands for an open end inside the block grid: the last date there is


def _overlaps_direct(rows: DataFrame, strict: bool) -> DataFrame:
    a = rows.select("k", *[F.col(c).alias(f"a_{n}") for c, n in (("i", "id"), ("s", "s"), ("e", "e"))])
    b = rows.select("k", *[F.col(c).alias(f"b_{n}") for c, n in (("i", "id"), ("s", "s"), ("e", "e"))])
    pairs = a.join(b, "k")
    if strict:
        until = lambda c: F.coalesce(c, F.lit(_NO_END).cast("date"))
        real = (F.col("a_s") <= until(F.col("a_e"))) & (F.col("b_s") <= until(F.col("b_e")))
        meet = (F.col("a_id") < F.col("b_id")) & real & (F.col("a_s") <= until(F.col("b_e"))) & (F.col("b_s") <= until(F.col("a_e")))
    else:
        within = lambda c: F.col(c).between(F.col("b_s"), F.col("b_e"))
        meet = (F.col("a_id") != F.col("b_id")) & (within("a_s") | within("a_e"))
    return pairs.where(meet).select("k", "a_id", "b_id")


def _overlaps_blocked(rows: DataFrame, strict: bool) -> DataFrame:
    day = lambda c: F.datediff(c, F.lit("1900-01-01").cast("date"))
    until = F.coalesce("e", F.lit(_NO_END).cast("date")) if strict else F.col("e")
    spans = rows.select("k", F.col("i").alias("b_id"), day(F.col("s")).alias("lo"), day(until).alias("hi")).where("lo <= hi")
    blocks = explode_blocks(spans, "lo", "hi").select("k", "b_id", F.col("lo").alias("b_lo"), "level", "block")
    # No block is larger than the longest range, so points need no higher levels.
    top = spans.agg(F.coalesce(top_level(F.max(F.col("hi") - F.col("lo")) + 1), F.lit(0))).scalar()
    if strict:
        ends = rows.where(F.col("s") <= until).select("k", "i", day(F.col("s")).alias("p"))
    else:
        ends = rows.select("k", "i", F.explode(F.array(day(F.col("s")), day(F.col("e")))).alias("p"))
        ends = ends.where("p is not null")
    points = (
        ends.select("k", F.col("i").alias("a_id"), "p", top.alias("top"))
        .select("k", "a_id", "p", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("level"))
        .withColumn("block", block_of(F.col("p"), F.col("level")))
    )
    pairs = points.join(blocks, ["k", "level", "block"]).where("a_id <> b_id")
    if strict:
        # Of two overlapping ranges the later start lies in the other; equal starts match both ways.
        return pairs.where("p > b_lo or (p = b_lo and a_id < b_id)").select(
            "k", F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id")
        )
    # Both end points of a may lie in b: the pair counts once.
    return pairs.select("k", "a_id", "b_id").distinct()


def scd2_intervals(
    changes: DataFrame, key: str, ts: str, seq: str, bucket: Column | None = None, op: str = "op"
) -> DataFrame:
    """Every change as a version: valid from its time to the time of the key's next change.

    `seq` is the unique change number; `bucket` (default: blocks of 100 000 numbers) bounds how
    many rows of one key are sorted together.
    """
    bucket = F.floor(F.col(seq) / 100_000) if bucket is None else bucket
    rows = changes.withColumnsRenamed({ts: "valid_from", op: "operation"})
    return next_in_group(rows, [key], [seq], F.col("valid_from"), bucket, "valid_to")


_OPERATIONS = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}


def scd2_apply(
    target: DataFrame | None,
    changes: DataFrame,
    key: str,
    ts: str = "changed_at",
    seq: str = "lsn",
    bucket: Column | None = None,
) -> DataFrame:
    """Apply a change feed to a version history.

    Inserts and updates close the open version and open a new one; a delete closes it and marks
    the closed row DELETE. `target` has the output columns; versions closed earlier are left alone.
    """
    values = [c for c in changes.columns if c not in (key, ts, seq, "op")]
    label = F.create_map(*[F.lit(x) for kv in _OPERATIONS.items() for x in kv])[F.col("op")]
    feed = changes.select(key, *values, F.col(ts).alias("valid_from"), label.alias("operation"), F.col(seq).alias("_seq"))
    settled = None
    if target is not None:
        touched = changes.select(key).distinct()
        is_open = F.col("valid_to").isNull()
        settled = target.where(~is_open).unionByName(target.where(is_open).join(touched, key, "left_anti"))
        reopened = target.where(is_open).join(touched, key, "left_semi")
        feed = feed.unionByName(reopened.select(key, *values, "valid_from", "operation", F.lit(-1).alias("_seq")))
    bucket = F.floor(F.col("_seq") / 100_000) if bucket is None else bucket
    following = F.struct(F.col("valid_from").alias("at"), F.col("operation").alias("op"))
    chained = next_in_group(feed, [key], ["_seq"], following, bucket, "_next")
    versions = chained.where("operation <> 'DELETE'").select(
        key,
        *values,
        "valid_from",
        F.col("_next.at").alias("valid_to"),
        F.when(F.col("_next.op") == "DELETE", "DELETE").otherwise(F.col("operation")).alias("operation"),
    )
    return versions if settled is None else settled.unionByName(versions)


def valid_at(history: DataFrame, as_of: str) -> DataFrame:
    """Versions in force at an instant."""
    t = F.lit(as_of).cast("timestamp_ntz")
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
