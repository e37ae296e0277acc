"""Streams against batch results."""

import datetime as dt

from pyspark.sql import functions as F

from terrawatt.operators import aggregates as agg
from terrawatt.operators import cleaning as cl
from terrawatt.streaming import streams as st

T = dt.datetime


def readings(spark, path, parts=3):
    df = spark.range(300).select(
        F.concat(F.lit("M"), (F.col("id") % 4).cast("string")).alias("meter_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97).alias("timestamp"),
        (F.col("id") % 60 + 1).cast("double").alias("energy_consumption"), F.lit(220.0).alias("voltage"),
        F.lit(5.0).alias("current_reading"), F.lit(0.9).alias("power_factor"), F.lit(50.0).alias("frequency"),
    )
    df.repartitionByRange(parts, "timestamp").write.parquet(path)
    return df


def test_incremental_equals_batch(spark, tmp_path, rows):
    df = readings(spark, str(tmp_path / "in"))
    stream = cl.clean_readings(st.file_stream(spark, str(tmp_path / "in"), df.schema))
    log = st.run_to_table(st.stream_incremental_agg(stream, watermark="1 day"), str(tmp_path / "out"), "update", str(tmp_path / "cp"))
    got = st.latest_revision(log, ["meter_id", "bucket"])
    assert log.select("epoch").distinct().count() > 1
    assert rows(got) == rows(agg.agg_partial_states(cl.clean_readings(df)))


def test_restart_adds_only_new_files(spark, tmp_path):
    df = readings(spark, str(tmp_path / "in"), 1)
    run = lambda: st.run_to_table(
        st.file_stream(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), "append", str(tmp_path / "cp")
    )
    assert run().count() == 300
    df.limit(7).write.mode("append").parquet(str(tmp_path / "in"))
    assert run().count() == 307


def test_dedupe_within_delay(spark, tmp_path):
    df = readings(spark, str(tmp_path / "in"), 1)
    df.write.mode("append").parquet(str(tmp_path / "in"))
    stream = st.stream_dedupe(st.file_stream(spark, str(tmp_path / "in"), df.schema), ["meter_id", "timestamp"], "timestamp", "12 hours")
    assert st.run_to_table(stream, str(tmp_path / "out")).count() == 300


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "meter_id string, timestamp timestamp, energy_consumption double, is_anomaly int"
    for i, at in enumerate([T(2024, 1, 1, 10), T(2024, 1, 1, 20), T(2024, 1, 1, 10, 30)]):
        spark.createDataFrame([("M", at, 1.0, 0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        log = st.run_to_table(st.stream_incremental_agg(stream), str(tmp_path / "out"), "update", str(tmp_path / "cp"))
    ten = st.latest_revision(log, ["meter_id", "bucket"]).where(F.hour("bucket") == 10).first()
    assert ten.n == 1  # the third row comes ten hours after the watermark passed its window


def test_upsert_batches(spark, tmp_path, rows):
    apply = st.upsert_batches(str(tmp_path / "u"), ["k"], "n")
    apply(spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, n int"), 0)
    second = spark.createDataFrame([(2, 5), (3, 1)], "k int, n int")
    apply(second, 1)
    apply(second, 1)  # a repeated batch changes nothing
    assert rows(spark.read.parquet(str(tmp_path / "u" / "v1"))) == [(1, 2), (2, 5), (3, 1)]


def test_partials_keep_late_rows_in_any_order(spark, tmp_path, rows):
    df = readings(spark, str(tmp_path / "ordered"))
    df.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = cl.clean_readings(st.file_stream(spark, str(tmp_path / "in"), df.schema))
    log = st.run_partials(stream, str(tmp_path / "out"), st.meter_partials, str(tmp_path / "cp"))
    assert log.select("epoch").distinct().count() == 6
    assert rows(st.merge_meter_partials(log)) == rows(agg.agg_partial_states(cl.clean_readings(df)))


def test_run_dedupe_over_batches(spark, tmp_path, rows):
    for i, part in enumerate([[(1, "a"), (None, "b")], [(1, "late"), (2, "c"), (2, "c")], [(None, "late"), (3, "d")]]):
        spark.createDataFrame(part, "k int, v string").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema("k int, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    got = st.run_dedupe(stream, str(tmp_path / "out"), ["k"], str(tmp_path / "cp"))
    assert sorted((r.k for r in got.collect()), key=str) == [1, 2, 3, None]
