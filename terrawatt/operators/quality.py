"""Profiling and data-quality scores. Each profile is one aggregation whatever the column count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawatt.functions.scalar import boundary_minutes, percent
from terrawatt.operators.cleaning import CURRENT_RANGE, VOLTAGE_RANGE

# Rule names and ranges of the metering domain.
RANGE_RULES = {
    "valid_energy_range": ("energy_consumption", 0.5, 5.0),
    "valid_voltage_range": ("voltage", 230, 240),
    "valid_current_range": ("current_reading", 1.0, 15.0),
    "valid_power_factor": ("power_factor", 0.85, 0.99),
    "valid_frequency": ("frequency", 49.8, 50.2),
}
CRITICAL_COLUMNS = ("energy_consumption", "voltage", "meter_id", "timestamp")
SCORE_TIERS = ((80, "LOW"), (95, "MODERATE"))
EXPECTED_EVENTS_PER_HOUR = 50_000
FRESH_MINUTES = 65


def meter_rules() -> dict[str, Column]:
    """The five named checks on readings."""
    return {
        "voltage BETWEEN 200-250": F.col("voltage").between(*VOLTAGE_RANGE),
        "current_reading BETWEEN 0-100": F.col("current_reading").between(*CURRENT_RANGE),
        "energy_consumption > 0": F.col("energy_consumption") > 0,
        "meter_id NOT NULL": F.col("meter_id").isNotNull(),
        "timestamp NOT NULL": F.col("timestamp").isNotNull(),
    }


def _all(rules: Mapping[str, Column]) -> Column:
    result = F.lit(True)
    for rule in rules.values():
        result = result & rule
    return result


def _rows(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn struct entries of a one-row aggregate into rows."""
    return one_row.select(F.inline(F.array(*entries)))


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.count_if(F.isnan(F.col(c))).alias("nan_count"),
        )
        for c in cols
    ]
    packed = df.agg(*[e.alias(f"_{i}") for i, e in enumerate(entries)])
    return _rows(packed, [F.col(f"_{i}") for i in range(len(cols))])


def profile_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.describe(*cols)


def profile_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), err: float = 0.05
) -> DataFrame:
    """Approximate quantiles with rank error `err`, all columns in one pass with bounded memory."""
    accuracy = max(1, round(1 / err))
    packed = df.agg(*[F.percentile_approx(c, list(probs), accuracy).alias(f"_{i}") for i, c in enumerate(cols)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("q"), F.col(f"_{i}")[j].cast("double").alias("value"))
        for i, c in enumerate(cols)
        for j, p in enumerate(probs)
    ]
    return _rows(packed, entries)


def profile_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    total = F.count(F.lit(1))
    packed = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                # NULL counts as one more distinct value.
                (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias("distinct"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.count_if(F.trim(F.col(c)) == "").alias("blanks"),
                percent(F.count_if(F.col(c).isNull()), total).alias("pct_null"),
                percent(F.count_if(F.trim(F.col(c)) == ""), total).alias("pct_blank"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    return _rows(packed, [F.col(f"_{i}") for i in range(len(cols))])


def profile_timestamps(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.agg(
        F.min(col).alias("min_timestamp"),
        F.max(col).alias("max_timestamp"),
        F.count(col).alias("total_count"),
        F.count_if(F.col(col).isNull()).alias("null_count"),
    )


def dq_rule_pass_rates(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    rules = meter_rules() if rules is None else rules
    names = list(rules)
    packed = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(rules[n]).alias(f"_{i}") for i, n in enumerate(names)]
    )
    entries = [
        F.struct(
            F.lit(n).alias("rule"),
            F.col(f"_{i}").alias("passed"),
            F.col("_total").alias("total"),
            percent(F.col(f"_{i}"), F.col("_total")).alias("pct"),
        )
        for i, n in enumerate(names)
    ]
    return _rows(packed, entries)


def dq_all_rules(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    rules = meter_rules() if rules is None else rules
    valid, total = F.count_if(_all(rules)), F.count(F.lit(1))
    return df.agg(valid.alias("valid"), total.alias("total"), percent(valid, total).alias("pct"))


def dq_null_failures(df: DataFrame, cols: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])
    clean = F.lit(True)
    for c in cols:
        clean = clean & (F.col(f"null_{c}") == 0)
    return counted.withColumn("status", F.when(clean, "PASSED").otherwise("FAILED"))


def dq_completeness_by_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    total = F.count(F.lit(1))
    packed = df.agg(*[percent(F.count(c), total).alias(f"_{i}") for i, c in enumerate(cols)])
    return _rows(
        packed, [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("pct")) for i, c in enumerate(cols)]
    )


def dq_quality_score(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    rules = meter_rules() if rules is None else rules
    scored = df.agg(percent(F.count_if(_all(rules)), F.count(F.lit(1))).alias("score"))
    (low, low_name), (mid, mid_name) = SCORE_TIERS
    tier = F.when(F.col("score") < low, low_name).when(F.col("score") < mid, mid_name).otherwise("HIGH")
    return scored.withColumn("tier", tier)


def _since(df: DataFrame, ts: str, as_of: str, hours: float) -> DataFrame:
    """Rows in the last `hours` before `as_of`: a constant lower bound that reaches the scan."""
    at = F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col(ts) >= at - F.make_dt_interval(secs=F.lit(hours * 3600.0)))


def dq_completeness_score(
    df: DataFrame, as_of: str, expected: int = EXPECTED_EVENTS_PER_HOUR, hours: float = 1, ts: str = "event_time"
) -> DataFrame:
    n = F.count(F.lit(1))
    return _since(df, ts, as_of, hours).agg(
        n.alias("actual_count"),
        F.lit(expected).alias("expected_count"),
        percent(n, F.lit(expected)).alias("completeness_score"),
    )


def dq_freshness(
    df: DataFrame, as_of: str, hours: float = 2, fresh_minutes: int = FRESH_MINUTES, ts: str = "event_time"
) -> DataFrame:
    at = F.lit(as_of).cast("timestamp_ntz")
    fresh = F.count_if(boundary_minutes(F.col(ts), at) < fresh_minutes)
    latest = F.max(ts)
    return _since(df, ts, as_of, hours).agg(
        latest.alias("latest_event"),
        F.timestamp_diff("SECOND", F.date_trunc("second", latest), at).alias("seconds_old"),
        percent(fresh, F.count(F.lit(1))).alias("freshness_score"),
    )


def dq_validity(
    df: DataFrame, as_of: str, cols: Mapping[str, str], hours: float = 1, ts: str = "event_time"
) -> DataFrame:
    """Null counts (`cols`: output name -> column) and the percentage of rows without any."""
    total = F.count(F.lit(1))
    some_null = F.lit(False)
    for c in cols.values():
        some_null = some_null | F.col(c).isNull()
    return _since(df, ts, as_of, hours).agg(
        total.alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in cols.items()],
        percent(total - F.count_if(some_null), total).alias("validity_score"),
    )


def dq_range_validation(df: DataFrame, ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    ranges = RANGE_RULES if ranges is None else ranges
    nulls = {"null_meter_ids": "meter_id", "null_timestamps": "timestamp",
             "null_energy": "energy_consumption", "null_voltage": "voltage"}
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).between(lo, hi)).alias(n) for n, (c, lo, hi) in ranges.items()],
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in nulls.items()],
    )


def dq_etl_postcheck(df: DataFrame, date: str) -> DataFrame:
    """Totals of one loaded day."""
    return df.where(F.col("date") == F.lit(date).cast("date")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("energy_consumption") > 0).alias("valid_consumption"),
        F.count_if(F.col("voltage").between(*VOLTAGE_RANGE)).alias("valid_voltage"),
        F.sum("is_anomaly").alias("anomalies"),
    )


def dq_issue_log(df: DataFrame, key: str, source: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row and failed rule; an unknown rule result counts as failed."""
    rules = meter_rules() if rules is None else rules
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]),
        lambda x: x.isNotNull(),
    )
    return df.select(
        F.lit(source).alias("source"), F.col(key).alias("key"), F.explode(failed).alias("issue_type")
    )


def dq_expected_vs_actual(df: DataFrame, expected: Mapping[str, int], label: str) -> DataFrame:
    """Expected and actual counts per label, difference included; labels missing on a side count 0."""
    want = df.sparkSession.createDataFrame(list(expected.items()), f"{label} string, expected long")
    have = df.groupBy(label).agg(F.count(F.lit(1)).alias("actual"))
    return want.join(have, label, "full_outer").select(
        label,
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce("actual", F.lit(0)).alias("actual"),
        (F.coalesce("actual", F.lit(0)) - F.coalesce("expected", F.lit(0))).alias("difference"),
    )


def feature_validate(
    features: DataFrame, rules: Sequence[Mapping], key: str = "ingest_id", geometry_error: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split point features into (valid, errors) by the enabled bounding-box rules.

    `rules`: dicts with rule_name, rule_type, is_enabled, bbox=(minx, miny, maxx, maxy). A missing
    geometry is an error of its own and, being unknown, breaks no box rule. Rules are configuration
    and become expressions, so this is a narrow pass without a join.
    """
    bad = F.col("lon").isNull() | F.col("lat").isNull() if geometry_error is None else geometry_error

    def error(code: str, text: str) -> Column:
        return F.struct(F.lit(code).alias("error_code"), F.lit(text).alias("error_msg"))

    checks = [F.when(bad, error("INVALID_GEOMETRY", "Geometry invalid"))]
    for r in rules:
        if r["is_enabled"] and r["rule_type"] == "GEOMETRY" and "bbox" in r:
            minx, miny, maxx, maxy = r["bbox"]
            x, y = F.col("lon"), F.col("lat")
            inside = (x > minx) & (x < maxx) & (y > miny) & (y < maxy)
            checks.append(F.when(~inside, error(r["rule_name"], "Geometry outside allowed extent")))
    checked = features.withColumn("_errors", F.filter(F.array(*checks), lambda e: e.isNotNull()))
    valid = checked.where(F.size("_errors") == 0).drop("_errors")
    errors = checked.select(key, F.explode("_errors").alias("_e")).select(key, "_e.error_code", "_e.error_msg")
    return valid, errors
