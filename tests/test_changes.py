"""Intervals, versions, upserts and CDC."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrawatt.operators import changes as ch
from terrawatt.operators import intervals as iv
from terrawatt.operators.skew import balanced_join, first_per_key, next_in_group

D = dt.date
T = dt.datetime
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def assignments(spark, spans):
    data = [(1, i, *s) for i, s in enumerate(spans)]
    return spark.createDataFrame(data, "contract_id int, assignment_id int, effective_from date, effective_to date")


def test_overlap_open_end_and_containment(spark, rows):
    a = assignments(spark, [(D(2020, 1, 1), None), (D(2020, 3, 1), D(2020, 4, 1))])
    # The second lies within the first, whose open end is unknown to BETWEEN: nothing is reported.
    assert rows(iv.interval_overlap_check(a)) == []
    assert rows(iv.interval_overlap_check(a, strict=True)) == [(1, 0, 1)]
    b = assignments(spark, [(D(2020, 1, 1), D(2020, 12, 1)), (D(2020, 3, 1), D(2020, 4, 1))])
    # The inner range has its ends in the outer one, not the other way round.
    assert rows(iv.interval_overlap_check(b)) == [(1, 1, 0)]
    assert rows(iv.interval_overlap_check(b, strict=True)) == [(1, 0, 1)]


def test_overlap_touching_ends(spark, rows):
    a = assignments(spark, [(D(2020, 1, 1), D(2020, 2, 1)), (D(2020, 2, 1), D(2020, 3, 1)), (D(2020, 3, 2), D(2020, 3, 5))])
    assert rows(iv.interval_overlap_check(a)) == [(1, 0, 1), (1, 1, 0)]
    assert rows(iv.interval_overlap_check(a, strict=True)) == [(1, 0, 1)]


@pytest.mark.parametrize("limit", [0, 64])
@QUICK
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-2, 40)), min_size=1, max_size=14))
def test_overlap_equals_brute_force(spark, limit, spans):
    day = lambda n: D(2020, 1, 1) + dt.timedelta(n)
    # -1 stands for an open end, -2 for a range that ends before it starts.
    ranges = [(day(s), None if n == -1 else day(s + n)) for s, n in spans]
    data = assignments(spark, ranges)
    pairs = lambda strict: sorted(
        (r.a_id, r.b_id) for r in iv.interval_overlap_check(data, strict=strict, direct_limit=limit).collect()
    )
    end = lambda r: r[1] or D(2249, 1, 1)
    n = range(len(ranges))
    real = [s <= end((s, e)) for s, e in ranges]
    assert pairs(True) == sorted(
        (i, j) for i in n for j in n if i < j and real[i] and real[j]
        and ranges[i][0] <= end(ranges[j]) and ranges[j][0] <= end(ranges[i])
    )
    inside = lambda p, r: p is not None and r[1] is not None and r[0] <= p <= r[1]
    assert pairs(False) == sorted(
        (i, j) for i in n for j in n if i != j and (inside(ranges[i][0], ranges[j]) or inside(ranges[i][1], ranges[j]))
    )


def test_asof_tariff(spark, rows):
    contracts = spark.createDataFrame([(1, 10, "Active"), (2, 20, "Expired")], "contract_id int, customer_id int, status string")
    tariffs = spark.createDataFrame(
        [(1, 1, 7, D(2020, 1, 1), None), (2, 1, 8, D(2020, 6, 1), None), (3, 1, 9, D(2030, 1, 1), None), (4, 2, 5, D(2020, 1, 1), None)],
        "assignment_id int, contract_id int, tariff_id int, effective_from date, effective_to date",
    )
    assert rows(iv.asof_active_tariff(contracts, tariffs, "2021-01-01")) == [(10, 8)]


def feed(spark, changes):
    data = [(i, k, op, v, T(2024, 1, 1) + dt.timedelta(hours=i)) for i, (k, op, v) in enumerate(changes)]
    return spark.createDataFrame(data, "lsn int, id int, op string, value double, changed_at timestamp_ntz")


def test_scd2_insert_update_delete_reinsert(spark):
    f = feed(spark, [(1, "c", 1.0), (1, "u", 2.0), (1, "d", 2.0), (1, "c", 3.0)])
    got = sorted(tuple(r) for r in iv.scd2_apply(None, f, "id").select("value", "operation", "valid_to").collect())
    h = lambda n: T(2024, 1, 1) + dt.timedelta(hours=n)
    assert got == [(1.0, "INSERT", h(1)), (2.0, "DELETE", h(2)), (3.0, "INSERT", None)]


def test_scd2_in_two_loads_equals_one(spark, rows):
    f = feed(spark, [(i % 3, "d" if i % 7 == 6 else "u", float(i)) for i in range(40)])
    history = iv.scd2_apply(None, f.where("lsn < 17"), "id")
    assert rows(iv.scd2_apply(history, f.where("lsn >= 17"), "id")) == rows(iv.scd2_apply(None, f, "id"))


def test_next_in_group_across_blocks(spark):
    df = spark.range(100).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("n"))
    got = next_in_group(df, ["k"], ["n"], F.col("n"), F.floor(F.col("n") / 7), "nxt").orderBy("n").collect()
    assert [r.nxt for r in got] == [*range(1, 100), None]


def test_upsert_last_wins(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, n int")
    assert rows(ch.merge_upsert(target, updates, ["id"], [F.col("n").desc()])) == [(1, "a"), (2, "y"), (3, "z")]


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_net_changes(spark, rows):
    f = feed(spark, [(1, "c", 1.0), (1, "u", 2.0), (2, "c", 1.0), (2, "d", 1.0), (3, "u", 5.0), (4, "u", 1.0), (4, "d", 1.0)])
    got = {(r.id, r.op, r.value) for r in ch.cdc_net_changes(f, "id", 0, 6).collect()}
    assert got == {(1, "c", 2.0), (3, "u", 5.0), (4, "d", 1.0)}


def test_debezium_missing_fields_and_nanos(spark):
    after = {"id": 1, "meter_id": "M", "timestamp": 1700000000123456789, "energy_consumption": "15.50", "frequency": ""}
    df = spark.createDataFrame([(json.dumps({"op": o, "after": after}),) for o in "cd"], "payload string")
    got = ch.cdc_parse_debezium(df).collect()
    assert len(got) == 1 and got[0].timestamp.microsecond == 123456
    assert got[0].power_factor is None and got[0].frequency is None and got[0].voltage is None


def test_unparsable_change_is_dropped(spark):
    df = spark.createDataFrame([("{broken",), (None,)], "payload string")
    assert ch.cdc_parse_debezium(df).count() == 0


def test_balanced_join_equals_join(spark, rows):
    left = spark.range(300).select("id", F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 5).alias("k"))
    right = spark.range(12).select((F.col("id") % 6).alias("k"), F.col("id").alias("r"))
    got = balanced_join(left, right, ["k"], ["id"], rows_per_task=20).select("id", "k", "r")
    assert rows(got) == rows(left.join(right, "k").select("id", "k", "r"))


def test_constraint_passes_on_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, "X")], "id int, s string")
    assert [tuple(r) for r in ch.check_constraint_report(df, {"s": F.col("s").isin("A")}, "id").collect()] == [(2, "s")]


def test_net_changes_with_shared_sequence_numbers(spark, rows):
    f = spark.createDataFrame([(1, 10, "c", "a", 1), (2, 10, "u", "b", 2), (3, 10, "c", "x", 3), (3, 10, "d", "x", 4)], "id int, lsn int, op string, value string, part int")
    assert rows(ch.cdc_net_changes(f, "id", 0, 99, tie="part")) == [(1, 10, "c", "a", 1), (2, 10, "u", "b", 2)]


def test_envelope_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "payload string")
    plan = ch.cdc_parse_debezium(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
