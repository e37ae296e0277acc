"""Scalar function families."""

from pyspark.sql import functions as F

from terrawatt.functions import scalar as sc
from terrawatt.plans.registry import query


@query("string_functions", r"""SELECT c_custkey, c_name LIKE 'Customer#00000000%' AS like_prefix, c_mktsegment ILIKE 'b%' AS ilike_b,
    concat('REGION_', c_mktsegment) AS joined, trim('  ') = '' AS blank, replace(c_name, '#', ' ') AS replaced,
    concat('METER_', lpad(CAST(c_custkey % 1000 AS VARCHAR), 4, '0')) AS padded,
    regexp_extract(concat('s3/date=2024-01-', lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0'), '/x'), 'date=(\d{4}-\d{2}-\d{2})', 1) AS path_date
    FROM customer""")
def _(t):
    k, name, seg = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    path = F.concat(F.lit("s3/date=2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/x"))
    return t.customer.select(
        k, name.like("Customer#00000000%").alias("like_prefix"), seg.ilike("b%").alias("ilike_b"),
        F.concat(F.lit("REGION_"), seg).alias("joined"), (F.trim(F.lit("  ")) == "").alias("blank"),
        F.replace(name, F.lit("#"), F.lit(" ")).alias("replaced"),
        F.concat(F.lit("METER_"), F.lpad((k % 1000).cast("string"), 4, "0")).alias("padded"),
        F.regexp_extract(path, r"date=(\d{4}-\d{2}-\d{2})", 1).alias("path_date"),
    )


@query("datetime_functions", """SELECT event_id, TRY_CAST(concat('2024-01-', CAST(event_id % 40 AS VARCHAR), ' 10:00:00') AS TIMESTAMP) AS parsed,
    CAST(ts AS DATE) AS d, year(ts) AS y, month(ts) AS mo, day(ts) AS dd, hour(ts) AS h, minute(ts) AS mi, date_trunc('hour', ts) AS start_of_hour,
    date_diff('minute', ts, TIMESTAMP '2024-01-31 00:00:00') AS minutes_old, ts - INTERVAL 1 HOUR AS hour_ago, epoch_us(ts) // 1000 AS epoch_ms,
    strftime(ts, '%Y%m') AS yyyymm, ts + INTERVAL 7 DAY AS in_a_week, epoch_us(ts) AS from_nanos_us FROM events""")
def _(t):
    ts = F.col("ts")
    text = F.concat(F.lit("2024-01-"), (F.col("event_id") % 40).cast("string"), F.lit(" 10:00:00"))
    utc = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp"))
    return t.events.select(
        "event_id", F.try_to_timestamp(text).cast("timestamp_ntz").alias("parsed"), F.to_date(ts).alias("d"),
        F.year(ts).alias("y"), F.month(ts).alias("mo"), F.dayofmonth(ts).alias("dd"), F.hour(ts).alias("h"), F.minute(ts).alias("mi"),
        F.date_trunc("hour", ts).cast("timestamp_ntz").alias("start_of_hour"),
        sc.boundary_minutes(ts, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).alias("minutes_old"),
        (ts - F.expr("INTERVAL 1 HOUR")).alias("hour_ago"), F.floor(utc / 1000).alias("epoch_ms"),
        F.date_format(ts, "yyyyMM").alias("yyyymm"), (ts + F.expr("INTERVAL 7 DAY")).alias("in_a_week"),
        utc.alias("from_nanos_us"),
    )


@query("math_functions", """SELECT o_orderkey, abs(o_totalprice - 200000) AS distance, o_totalprice / nullif(o_orderkey % 3, 0) AS ratio,
    round(o_totalprice / 7, 2) AS rounded, 1 / (1 + o_totalprice) AS closeness, greatest(0.0, least(1.0, o_totalprice / 262144)) AS clamped,
    ln(o_totalprice) AS log_price, CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 11
    ELSE CAST(floor(o_totalprice / 50000) AS BIGINT) + 1 END AS bucket FROM orders""", "distance ratio:8 rounded closeness clamped:9 log_price")
def _(t):
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    return t.orders.select(
        k, F.abs(p - 200000).alias("distance"), F.try_divide(p, F.nullif(k % 3, F.lit(0))).alias("ratio"),
        F.round(p / 7, 2).alias("rounded"), (1 / (1 + p)).alias("closeness"), sc.clamp01(p / 262144).alias("clamped"),
        F.ln(p).alias("log_price"), F.width_bucket(p, F.lit(0.0), F.lit(500000.0), F.lit(10)).alias("bucket"),
    )


@query("conditional_functions", """SELECT event_id, coalesce(signal_strength, -1.0) AS filled, CASE WHEN signal_strength < 10 THEN 'CRITICAL'
    WHEN signal_strength < 20 THEN 'HIGH' ELSE 'OK' END AS severity, nullif(latency_ms, 0) AS latency,
    CASE WHEN event_id % 2 = 0 THEN NULL ELSE data_usage_mb END AS not_nan FROM network_events""", "filled latency not_nan")
def _(t):
    s = F.col("signal_strength")
    broken = F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("data_usage_mb"))
    return t.network_events.select(
        "event_id", F.coalesce(s, F.lit(-1.0)).alias("filled"),
        F.when(s < 10, "CRITICAL").when(s < 20, "HIGH").otherwise("OK").alias("severity"),
        F.nullif(F.col("latency_ms"), F.lit(0.0)).alias("latency"), sc.nan_to_null(broken).alias("not_nan"),
    )


@query("json_functions", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing,
    json_extract_string(props, '$.k') IS NOT NULL AS has_k, concat('{"event_id":', CAST(event_id AS VARCHAR), ',"event_type":"', event_type, '"}') AS packed,
    CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS from_variant FROM events""")
def _(t):
    props = F.col("props")
    return t.events.select(
        "event_id", F.from_json(props, "k bigint")["k"].alias("k"), F.get_json_object(props, "$.missing").alias("missing"),
        F.get_json_object(props, "$.k").isNotNull().alias("has_k"), F.to_json(F.struct("event_id", "event_type")).alias("packed"),
        (F.try_variant_get(F.parse_json(props), "$.k", "bigint") + 1).alias("from_variant"),
    )


@query("feature_checksum", "SELECT ingest_id, sha256(payload) AS checksum FROM features")
def _(t):
    no_geometry = F.lit(None).cast("binary")
    return t.features.select("ingest_id", sc.sha256_of(F.col("payload"), no_geometry).alias("checksum"))


@query("array_membership", "SELECT id, id IN (3, 5, 8, 13) AS member FROM points")
def _(t):
    wanted = F.array(*[F.lit(i).cast("bigint") for i in (3, 5, 8, 13)])
    return t.points.select("id", F.array_contains(wanted, F.col("id")).alias("member"))


@query("decimal_cast", """SELECT event_id, CAST(TRY_CAST(CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN 'n/a'
    ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM events""", "amount")
def _(t):
    text = F.when(F.col("event_id") % 9 == 0, "").when(F.col("event_id") % 10 == 0, "n/a").otherwise(
        F.col("value").cast("decimal(10,2)").cast("string")
    )
    return t.events.select("event_id", sc.decimal_cast(text, 2).alias("amount"))
