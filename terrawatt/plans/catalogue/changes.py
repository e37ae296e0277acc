"""Change data, upserts, audit, constraints, retention."""

from pyspark.sql import functions as F

from terrawatt.operators import changes as ch
from terrawatt.operators import intervals as iv
from terrawatt.plans.catalogue.joining import CDC_ROWS
from terrawatt.plans.registry import query

DECIMALS = ("energy_consumption", "voltage", "current_reading", "power_factor", "frequency")


@query("cdc_parse_debezium", "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS) + f") FROM ({CDC_ROWS})",
       " ".join(DECIMALS))
def _(t):
    return ch.cdc_parse_debezium(t.cdc_json)


@query("cdc_operation_labels", """SELECT lsn, CASE code WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'UPDATE (before)'
    WHEN 4 THEN 'UPDATE (after)' END AS operation_type FROM (SELECT lsn, lsn % 5 AS code FROM change_feed)""")
def _(t):
    coded = t.change_feed.select("lsn", (F.col("lsn") % 5).alias("operation"))
    return ch.cdc_operation_labels(coded).select("lsn", "operation_type")


@query("cdc_net_changes", """SELECT id, lsn, value, changed_at, CASE WHEN op = 'd' THEN 'd' WHEN f = 'c' THEN 'c' ELSE 'u' END AS op FROM (
    SELECT *, first_value(op) OVER (PARTITION BY id ORDER BY lsn) AS f, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn
    FROM change_feed WHERE lsn BETWEEN (SELECT max(lsn) / 2 FROM change_feed) AND (SELECT max(lsn) FROM change_feed)) WHERE rn = 1 AND NOT (f = 'c' AND op = 'd')""", "value")
def _(t):
    top = t.change_feed.agg(F.max("lsn")).scalar()
    return ch.cdc_net_changes(t.change_feed, "id", top / 2, top)


LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM change_feed) WHERE rn = 1"


@query("cdc_apply_snapshot", f"SELECT lsn, id, value, changed_at FROM ({LATEST}) WHERE op <> 'd'", "value")
def _(t):
    return ch.cdc_apply_snapshot(t.change_feed, "id")


@query("scd2_intervals", """SELECT lsn, id, op AS operation, value, changed_at AS valid_from,
    lead(changed_at) OVER (PARTITION BY id ORDER BY lsn) AS valid_to FROM change_feed""", "value")
def _(t):
    # Narrow blocks make the test data cross block borders as the large tables do.
    return iv.scd2_intervals(t.change_feed, "id", "changed_at", "lsn", bucket=F.floor(F.col("lsn") / 500))


@query("scd2_apply", """SELECT id, value, valid_from, valid_to, CASE WHEN nxt = 'd' THEN 'DELETE' WHEN op = 'u' THEN 'UPDATE' ELSE 'INSERT' END AS operation
    FROM (SELECT *, changed_at AS valid_from, lead(changed_at) OVER w AS valid_to, lead(op) OVER w AS nxt FROM change_feed
    WINDOW w AS (PARTITION BY id ORDER BY lsn)) WHERE op <> 'd'""", "value")
def _(t):
    # The first half builds a history, the second half is applied to it.
    feed = t.change_feed
    half = feed.agg(F.max("lsn") / 2).scalar()
    history = iv.scd2_apply(None, feed.where(F.col("lsn") <= half), "id")
    return iv.scd2_apply(history, feed.where(F.col("lsn") > half), "id")


@query("merge_upsert", f"""SELECT id, value, changed_at FROM ({LATEST}) UNION ALL
    SELECT c_custkey, c_acctbal, TIMESTAMP '2020-01-01' FROM customer WHERE c_custkey NOT IN (SELECT id FROM change_feed)""", "value")
def _(t):
    target = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.lit("2020-01-01").cast("timestamp_ntz").alias("changed_at")
    )
    return ch.merge_upsert(target, t.change_feed, ["id"], [F.col("lsn").desc()])


@query("dedupe_by_checksum", """SELECT sha256(text) AS checksum, max(doc_id) AS doc_id, count(*) > 0 AS kept FROM documents GROUP BY 1""")
def _(t):
    rows = t.documents.select("doc_id", "text")
    kept = ch.dedupe_by_checksum(rows, "text", None, [F.col("doc_id").desc()])
    return kept.select("checksum", "doc_id", F.lit(True).alias("kept"))


@query("dedupe_listings_by_url", """SELECT page_id, listing_key FROM (SELECT page_id, listing_key, row_number() OVER (PARTITION BY listing_key ORDER BY page_id) AS rn
    FROM (SELECT page_id, coalesce(nullif(regexp_extract(url, '^(https?://[^/?#]+)', 1), ''), concat(url, '#', 'None')) AS listing_key FROM pages)) WHERE rn = 1""")
def _(t):
    listings = t.pages.select(
        "page_id", F.col("url").alias("page_url"), F.regexp_extract("url", "^(https?://[^/?#]+)", 1).alias("listing_url"),
        F.lit(None).cast("string").alias("title"),
    )
    return ch.dedupe_listings_by_url(listings, [F.col("page_id")]).select("page_id", "listing_key")


@query("audit_change_log", """SELECT 'customer' AS table_name, CASE WHEN o.k IS NULL THEN 'INSERT' WHEN n.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
    CAST(coalesce(o.k, n.k) AS VARCHAR) AS record_id, o.j AS old_data, n.j AS new_data
    FROM (SELECT c_custkey AS k, concat('{"id":', CAST(c_custkey AS VARCHAR), ',"segment":"', c_mktsegment, '"}') AS j FROM customer WHERE c_custkey % 5 <> 0) AS o
    FULL JOIN (SELECT c_custkey AS k, concat('{"id":', CAST(c_custkey AS VARCHAR), ',"segment":"', CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END, '"}') AS j
    FROM customer WHERE c_custkey % 7 <> 0) AS n ON o.k = n.k WHERE o.j IS DISTINCT FROM n.j""")
def _(t):
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    moved = rows.withColumn("segment", F.when(F.col("id") % 4 == 0, "MOVED").otherwise(F.col("segment")))
    return ch.audit_change_log(rows.where("id % 5 <> 0"), moved.where("id % 7 <> 0"), "id", "customer")


@query("expire_contracts", """SELECT contract_id, CASE WHEN end_date < DATE '1998-06-01' AND status = 'Active' THEN 'Expired' ELSE status END AS status
    FROM contract""")
def _(t):
    return ch.expire_contracts(t.contract, "1998-06-01").select("contract_id", "status")


@query("guard_meter_delete", """SELECT meter_id, meter_id IN (SELECT meter_id FROM customer_meter WHERE end_date IS NULL) AS rejected
    FROM (SELECT o_orderkey AS meter_id FROM orders WHERE o_orderkey % 3 = 0)""")
def _(t):
    deletes = t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("meter_id"))
    allowed, rejected = ch.guard_meter_delete(deletes, t.customer_meter)
    return allowed.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))


@query("meter_health_status", """SELECT meter_id, CASE WHEN online AND signal_strength >= 80 THEN 'Active' WHEN online THEN 'Degraded' ELSE 'Inactive' END AS status
    FROM (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY last_seen DESC, status_id DESC) AS rn FROM meter_status) WHERE rn = 1""")
def _(t):
    return ch.meter_health_status(t.meter_status.select("meter_id").distinct(), t.meter_status)


@query("check_constraint_report", """SELECT contract_id, 'status_domain' AS constraint_name FROM contract WHERE NOT (status IN ('Active', 'Expired'))
    UNION ALL SELECT contract_id, 'end_after_1996' FROM contract WHERE NOT (end_date >= DATE '1996-01-01')""")
def _(t):
    domains = {
        "status_domain": F.col("status").isin("Active", "Expired"),
        "end_after_1996": F.col("end_date") >= F.lit("1996-01-01").cast("date"),
    }
    return ch.check_constraint_report(t.contract, domains, "contract_id")


@query("fk_violations", """SELECT contract_id, customer_id FROM contract WHERE customer_id NOT IN
    (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)""")
def _(t):
    parents = t.customer.where("c_custkey % 10 <> 0")
    return ch.fk_violations(t.contract, parents, "customer_id", "c_custkey").select("contract_id", "customer_id")


@query("retention_delete", """SELECT event_id FROM meter_readings WHERE timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""")
def _(t):
    return ch.retention_delete(t.meter_readings, "timestamp", "2024-01-31", 20).select("event_id")
