"""Cleaning and aggregation on the small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from terrawatt.operators import aggregates as agg
from terrawatt.operators import cleaning as cl
from terrawatt.operators import quality as dq
from terrawatt.operators import windows as win
from terrawatt.sources.scans import METER_SCHEMA, scan_inline_sample

VALID = [
    ("METER_001", "2024-01-15 10:00:00", 15.75, 220.5, 7.1, 0.95, 50.0),
    ("METER_002", "2024-01-15 10:01:00", 22.30, 219.8, 10.2, 0.92, 49.9),
    ("METER_003", "2024-01-15 10:02:00", 18.45, 221.2, 8.3, 0.98, 50.1),
    ("METER_001", "2024-01-15 11:00:00", 14.20, 220.8, 6.4, 0.96, 50.1),
    ("METER_002", "2024-01-15 11:01:00", 20.15, 219.9, 9.1, 0.93, 49.9),
]
INVALID = [
    (None, "2024-01-15 10:00:00", 15.0, 220.0, 7.0, 0.95, 50.0),
    ("METER_001", "2024-01-15 10:00:00", None, 220.0, 7.0, 0.95, 50.0),
    ("METER_002", "2024-01-15 10:00:00", 15.0, 180.0, 7.0, 0.95, 50.0),
    ("METER_003", "2024-01-15 10:00:00", -5.0, 220.0, 7.0, 0.95, 50.0),
]


def test_valid_rows_pass(spark):
    clean = cl.clean_readings(scan_inline_sample(spark, VALID))
    assert clean.count() == 5
    assert {r[0] for r in clean.select("consumption_category").collect()} == {"MEDIUM"}
    assert agg.agg_meter_daily(clean).count() == 3
    assert agg.agg_meter_hourly(clean).count() == 5


def test_fill_then_validate_keeps_one(spark):
    kept = cl.clean_readings(scan_inline_sample(spark, INVALID)).collect()
    assert [(r.meter_id, r.energy_consumption) for r in kept] == [("METER_001", 15.0)]


def test_warehouse_fill_drops_null_voltage(spark):
    df = scan_inline_sample(spark, [("M", "2024-01-15 10:00:00", 1.0, None, 7.0, 0.9, 50.0)])
    assert cl.validate_meter(cl.fill_defaults(df, cl.WAREHOUSE_DEFAULTS)).count() == 0
    assert cl.validate_meter(cl.fill_defaults(df)).count() == 1


def test_bad_timestamp_is_null(spark):
    df = scan_inline_sample(spark, [("M", "not a time", 1.0, 220.0, 7.0, 0.9, 50.0)])
    assert cl.derive_time_parts(df).first().timestamp is None


def test_null_energy_is_high_without_fill(spark):
    df = scan_inline_sample(spark, INVALID[1:2])
    assert cl.consumption_category(df).first().consumption_category == "HIGH"


def test_single_row_day_has_null_deviation(spark):
    daily = agg.agg_meter_daily(cl.clean_readings(scan_inline_sample(spark, VALID[2:3])))
    assert daily.first().std_energy_daily is None


def test_merge_of_split_loads_equals_one_load(spark, rows):
    clean = cl.clean_readings(scan_inline_sample(spark, VALID))
    first, second = clean.where("meter_id = 'METER_001'"), clean.where("meter_id <> 'METER_001'")
    parts = agg.agg_partial_states(first).unionByName(agg.agg_partial_states(second))
    assert rows(agg.merge_partial_states(parts, "day")) == rows(agg.merge_partial_states(agg.agg_partial_states(clean), "day"))


def test_coerce_schema_defaults(spark):
    loose = spark.createDataFrame([("M", "x", "7")], "meter_id string, energy_consumption string, voltage string")
    row = cl.coerce_schema(loose, METER_SCHEMA).first()
    assert (row.energy_consumption, row.voltage, row.frequency, row.timestamp) == (0.0, 7.0, 0.0, None)


def test_width_bucket_borders(spark, rows):
    df = spark.createDataFrame([(-1.0,), (0.0,), (99.9,), (100.0,), (None,)], "x double")
    got = dict((r[0], r[1]) for r in agg.agg_histogram_width_bucket(df, "x", 0, 100, 10).collect())
    assert got == {0: 1, 1: 1, 10: 1, 11: 1, None: 1}


def test_topk_null_first_and_tie_by_id(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 9.0)], "id int, x double")
    assert [r.id for r in win.topk_simple(df, "x", "id").collect()] == [2, 3, 4]
    assert [r.id for r in win.topk_simple(df, "x", "id", nulls_first=False).collect()] == [3, 4, 1]


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "k string, x double")
    shares = {r.k: r.percentage for r in win.win_share_of_total(df, "k", {"s": F.sum("x")}, "s").collect()}
    assert shares == {"a": 0.75, "b": 0.25}


def test_rules_log_and_score(spark):
    df = scan_inline_sample(spark, INVALID + VALID)
    log = dq.dq_issue_log(df.withColumn("id", F.monotonically_increasing_id()), "id", "t")
    assert log.count() == 4
    score = dq.dq_quality_score(df).first()
    assert round(score.score, 3) == round(500 / 9, 3) and score.tier == "LOW"


def test_freshness_counts_minute_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59, 59),)], "event_time timestamp_ntz")
    row = dq.dq_freshness(df, "2024-01-01 02:04:00").first()
    assert row.freshness_score == 0.0 and row.seconds_old == 3841  # 65 boundaries, though 64 whole minutes


def test_hot_meter_needs_no_wide_window(spark):
    clean = cl.clean_readings(scan_inline_sample(spark, VALID))
    plan = agg.agg_meter_daily(clean)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Window" not in plan
