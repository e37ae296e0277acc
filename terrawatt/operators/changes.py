"""Change data, upserts, audit, constraints and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.functions.scalar import decimal_cast, nanos_to_timestamp, sha256_of
from terrawatt.operators.skew import first_per_key

# Change-table operation codes.
CHANGE_CODES = {1: "DELETE", 2: "INSERT", 3: "UPDATE (before)", 4: "UPDATE (after)"}
CDC_SOURCE = "mssql_cdc"
PRODUCER_SOURCE = "kafka_producer"
KEPT_OPERATIONS = ("c", "u", "r")

ENVELOPE_SCHEMA = (
    "struct<op:string,after:struct<id:bigint,meter_id:string,timestamp:bigint,energy_consumption:string,"
    "voltage:string,current_reading:string,power_factor:string,frequency:string,status:string,"
    "created_at:bigint,updated_at:bigint>>"
)
PRODUCER_SCHEMA = (
    "struct<meter_id:string,timestamp:string,kwh_usage:double,voltage:int,customer_id:string,region:string>"
)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Target with the updates applied; of several updates to a key the last in `order` wins.

    The anti join leaves a large target unshuffled when the updates are small enough to broadcast.
    """
    last = first_per_key(updates, keys, order)
    return target.join(last, list(keys), "left_anti").unionByName(last.select(*target.columns))


def dedupe_by_checksum(df: DataFrame, payload: str, wkb: str | None, order: Sequence[Column]) -> DataFrame:
    """One row per content checksum: the first in `order` (pass descending order to keep the last)."""
    body = F.col(wkb) if wkb else None
    return first_per_key(df.withColumn("checksum", sha256_of(F.col(payload), body)), ["checksum"], order)


def dedupe_listings_by_url(df: DataFrame, order: Sequence[Column], page_url: str = "page_url") -> DataFrame:
    """First listing per URL; a listing without one is keyed by its page and title."""
    fallback = F.concat(F.col(page_url), F.lit("#"), F.coalesce(F.col("title"), F.lit("None")))
    key = F.coalesce(F.nullif(F.col("listing_url"), F.lit("")), fallback)
    return first_per_key(df.withColumn("listing_key", key), ["listing_key"], order)


def audit_change_log(old: DataFrame, new: DataFrame, key: str, table: str) -> DataFrame:
    """Differences of two snapshots as (table, operation, record id, old row, new row)."""
    pack = lambda df: F.to_json(F.struct(*df.columns))
    o = old.select(F.col(key).alias("_k"), pack(old).alias("old_data"))
    n = new.select(F.col(key).alias("_k"), pack(new).alias("new_data"))
    operation = (
        F.when(F.col("old_data").isNull(), "INSERT").when(F.col("new_data").isNull(), "DELETE").otherwise("UPDATE")
    )
    return (
        o.join(n, "_k", "full_outer")
        .where(~F.col("old_data").eqNullSafe(F.col("new_data")))
        .select(
            F.lit(table).alias("table_name"),
            operation.alias("operation"),
            F.col("_k").cast("string").alias("record_id"),
            "old_data",
            "new_data",
        )
    )


def cdc_operation_labels(df: DataFrame, code: str = "operation") -> DataFrame:
    label = None
    for value, text in CHANGE_CODES.items():
        test = F.col(code) == value
        label = F.when(test, text) if label is None else label.when(test, text)
    return df.withColumn("operation_type", label)


def cdc_net_changes(changes: DataFrame, key: str, from_lsn, to_lsn, seq: str = "lsn", tie: str | None = None) -> DataFrame:
    """One net change per key in a log range, with the last values.

    Created and deleted within the range: nothing. Created: c. Deleted: d. Otherwise u. Rows of one
    transaction may share `seq`; `tie` orders those of one key. The bounds are numbers or columns.
    """
    window = changes.where(F.col(seq).between(from_lsn, to_lsn))
    at = F.struct(seq, tie) if tie else F.col(seq)
    others = [c for c in changes.columns if c not in (key, "op")]
    ends = window.groupBy(key).agg(F.min_by("op", at).alias("_first"), F.max_by(F.struct("op", *others), at).alias("_last"))
    first, last = F.col("_first"), F.col("_last.op")
    net = F.when((first == "c") & (last != "d"), "c").when(last == "d", "d").otherwise("u")
    values = {c: F.col(f"_last.{c}") for c in others} | {"op": net, key: F.col(key)}
    return ends.where(~((first == "c") & (last == "d"))).select(*[values[c].alias(c) for c in changes.columns])


def cdc_apply_snapshot(changes: DataFrame, key: str, seq: str = "lsn") -> DataFrame:
    """Current rows from a change log: latest change per key, deleted keys removed."""
    return first_per_key(changes, [key], [F.col(seq).desc()]).where("op <> 'd'").drop("op")


def cdc_parse_debezium(df: DataFrame, value: str = "payload") -> DataFrame:
    """Typed rows of a change envelope, inserts, updates and snapshot reads only.

    Missing or empty optional values are NULL. Epoch nanoseconds are cut to microseconds.
    """
    # Behind a generator the envelope is parsed once; a column would be parsed for the filter and again for the values.
    e = F.inline(F.array(F.struct(F.from_json(F.col(value), ENVELOPE_SCHEMA).alias("_e"))))
    a = lambda name: F.col(f"_e.after.{name}")
    return (
        df.select(e)
        .where(F.col("_e.op").isin(*KEPT_OPERATIONS))
        .select(
            a("id").alias("id"),
            a("meter_id").alias("meter_id"),
            nanos_to_timestamp(a("timestamp")).alias("timestamp"),
            decimal_cast(a("energy_consumption"), 2).alias("energy_consumption"),
            decimal_cast(a("voltage"), 2).alias("voltage"),
            decimal_cast(a("current_reading"), 2).alias("current_reading"),
            decimal_cast(a("power_factor"), 3).alias("power_factor"),
            decimal_cast(a("frequency"), 2).alias("frequency"),
            a("status").alias("status"),
            nanos_to_timestamp(a("created_at")).alias("created_at"),
            nanos_to_timestamp(a("updated_at")).alias("updated_at"),
            F.col("_e.op").alias("cdc_operation"),
            F.lit(CDC_SOURCE).alias("cdc_source"),
        )
    )


def parse_producer(df: DataFrame, value: str = "payload") -> DataFrame:
    """Typed rows of the direct producer topic; an unreadable time is NULL."""
    p = lambda name: F.col(f"_p.{name}")
    return df.withColumn("_p", F.from_json(F.col(value), PRODUCER_SCHEMA)).select(
        p("meter_id").alias("meter_id"),
        F.try_to_timestamp(p("timestamp")).cast("timestamp_ntz").alias("timestamp"),
        p("kwh_usage").cast("decimal(18,2)").alias("kwh_usage"),
        p("voltage").alias("voltage"),
        p("customer_id").alias("customer_id"),
        p("region").alias("region"),
        F.lit(PRODUCER_SOURCE).alias("source"),
    )


def expire_contracts(df: DataFrame, as_of: str) -> DataFrame:
    due = (F.col("end_date") < F.lit(as_of).cast("date")) & (F.col("status") == "Active")
    return df.withColumn("status", F.when(due, "Expired").otherwise(F.col("status")))


def guard_meter_delete(deletes: DataFrame, assignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split delete requests into (allowed, rejected): a meter with an open assignment stays."""
    held = assignments.where(F.col("end_date").isNull()).select("meter_id")
    return deletes.join(held, "meter_id", "left_anti"), deletes.join(held, "meter_id", "left_semi")


def meter_health_status(meters: DataFrame, status: DataFrame, good_signal: int = 80) -> DataFrame:
    """Health of each meter by its latest communication status."""
    latest = first_per_key(status, ["meter_id"], [F.col("last_seen").desc(), F.col("status_id").desc()])
    health = (
        F.when(F.col("online") & (F.col("signal_strength") >= good_signal), "Active")
        .when(F.col("online"), "Degraded")
        .otherwise("Inactive")
    )
    return meters.join(latest, "meter_id").select("meter_id", health.alias("status"))


def check_constraint_report(df: DataFrame, domains: Mapping[str, Column], key: str) -> DataFrame:
    """Rows that break a check, one per broken check. As in SQL, an unknown result passes."""
    failed = F.filter(
        F.array(*[F.when(~rule, F.lit(name)) for name, rule in domains.items()]), lambda x: x.isNotNull()
    )
    return df.select(F.col(key), F.explode(failed).alias("constraint_name"))


def fk_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(keys, key, "left_anti")


def retention_delete(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    """Rows at most `days` days old; on a partition column this prunes whole folders."""
    return df.where(F.col(col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def partition_stats(df: DataFrame, col: str | Column) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
