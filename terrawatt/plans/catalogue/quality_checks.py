"""Profiles and quality scores."""

from pyspark.sql import functions as F

from terrawatt.operators import cleaning as cl
from terrawatt.operators import quality as dq
from terrawatt.operators.setops import missing_ids, union_all_literals
from terrawatt.plans.catalogue.metering import CLEAN, clean
from terrawatt.plans.datasets import AS_OF_EVENTS
from terrawatt.plans.registry import query

NUMERIC = ["voltage", "current_reading", "energy_consumption", "power_factor", "frequency"]
RULES_SQL = {
    "voltage BETWEEN 200-250": "voltage BETWEEN 200 AND 250",
    "current_reading BETWEEN 0-100": "current_reading BETWEEN 0 AND 100",
    "energy_consumption > 0": "energy_consumption > 0",
    "meter_id NOT NULL": "meter_id IS NOT NULL",
    "timestamp NOT NULL": "timestamp IS NOT NULL",
}
ALL_RULES = " AND ".join(f"({r})" for r in RULES_SQL.values())


def _each(template: str, items) -> str:
    return " UNION ALL ".join(template.format(*([i] if isinstance(i, str) else i)) for i in items)


@query("profile_numeric", _each("""SELECT '{0}' AS "column", count({0}) AS count, avg({0}) AS mean, stddev_samp({0}) AS stddev,
    min({0}) AS min, max({0}) AS max, count(*) - count({0}) AS null_count, CAST(0 AS BIGINT) AS nan_count FROM meter_readings""", NUMERIC),
       "mean stddev min max")
def _(t):
    return dq.profile_numeric(t.meter_readings, NUMERIC)


def _describe_sql() -> str:
    measures = {"count": "count({0})", "mean": "avg({0})", "stddev": "stddev_samp({0})", "min": "min({0})", "max": "max({0})"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, " + ", ".join(f"CAST({m.format(c)} AS DOUBLE) AS {c}" for c in NUMERIC) + " FROM meter_readings"
        for name, m in measures.items()
    )


@query("profile_describe", _describe_sql(), " ".join(NUMERIC))
def _(t):
    return dq.profile_describe(t.meter_readings, NUMERIC).select("summary", *[F.col(c).cast("double").alias(c) for c in NUMERIC])


@query("profile_quantiles", _each("""SELECT 'energy_consumption' AS "column", CAST({0} AS DOUBLE) AS q,
    quantile_disc(energy_consumption, {0}) AS value FROM meter_readings""", ["0.0", "0.25", "0.5", "0.75", "1.0"]), "q value")
def _(t):
    # A rank error far below one row makes the sketch exact at test scale.
    return dq.profile_quantiles(t.meter_readings, ["energy_consumption"], err=1e-5)


@query("profile_strings", """SELECT 'meter_id' AS "column", count(DISTINCT meter_id) + max(CASE WHEN meter_id IS NULL THEN 1 ELSE 0 END) AS distinct,
    count(*) - count(meter_id) AS nulls, count(*) FILTER (trim(meter_id) = '') AS blanks,
    (count(*) - count(meter_id)) * 100.0 / count(*) AS pct_null,
    count(*) FILTER (trim(meter_id) = '') * 100.0 / count(*) AS pct_blank FROM meter_readings""", "pct_null pct_blank")
def _(t):
    return dq.profile_strings(t.meter_readings, ["meter_id"])


@query("profile_timestamps", """SELECT min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp, count(timestamp) AS total_count,
    count(*) - count(timestamp) AS null_count FROM meter_readings""")
def _(t):
    return dq.profile_timestamps(t.meter_readings)


@query("dq_rule_pass_rates", _each("""SELECT '{0}' AS rule, count(*) FILTER ({1}) AS passed, count(*) AS total,
    count(*) FILTER ({1}) * 100.0 / count(*) AS pct FROM meter_readings""", RULES_SQL.items()), "pct")
def _(t):
    return dq.dq_rule_pass_rates(t.meter_readings)


@query("dq_all_rules", f"""SELECT count(*) FILTER ({ALL_RULES}) AS valid, count(*) AS total,
    count(*) FILTER ({ALL_RULES}) * 100.0 / count(*) AS pct FROM meter_readings""", "pct")
def _(t):
    return dq.dq_all_rules(t.meter_readings)


@query("dq_null_failures", """SELECT *, CASE WHEN null_energy_consumption + null_voltage + null_meter_id + null_timestamp = 0
    THEN 'PASSED' ELSE 'FAILED' END AS status FROM (SELECT count(*) - count(energy_consumption) AS null_energy_consumption,
    count(*) - count(voltage) AS null_voltage, count(*) - count(meter_id) AS null_meter_id,
    count(*) - count(timestamp) AS null_timestamp FROM meter_readings)""")
def _(t):
    return dq.dq_null_failures(t.meter_readings)


@query("dq_completeness_by_column", _each("""SELECT '{0}' AS "column", count({0}) * 100.0 / count(*) AS pct FROM meter_readings""",
                                          ["event_id", "meter_id", "timestamp", "energy_consumption", *[n for n in NUMERIC if n != "energy_consumption"]]), "pct")
def _(t):
    return dq.dq_completeness_by_column(t.meter_readings)


@query("dq_quality_score", f"""SELECT score, CASE WHEN score < 80 THEN 'LOW' WHEN score < 95 THEN 'MODERATE' ELSE 'HIGH' END AS tier
    FROM (SELECT count(*) FILTER ({ALL_RULES}) * 100.0 / count(*) AS score FROM meter_readings)""", "score")
def _(t):
    return dq.dq_quality_score(t.meter_readings)


@query("dq_completeness_score", """SELECT count(*) AS actual_count, 50000 AS expected_count,
    count(*) * 100.0 / 50000 AS completeness_score FROM network_events
    WHERE event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR""", "completeness_score")
def _(t):
    return dq.dq_completeness_score(t.network_events, AS_OF_EVENTS, hours=24)


@query("dq_freshness", """SELECT max(event_time) AS latest_event,
    date_diff('second', max(event_time), TIMESTAMP '2024-01-31 00:00:00') AS seconds_old,
    count(*) FILTER (date_diff('minute', event_time, TIMESTAMP '2024-01-31 00:00:00') < 65) * 100.0 / count(*) AS freshness_score
    FROM network_events WHERE event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR""", "freshness_score")
def _(t):
    return dq.dq_freshness(t.network_events, AS_OF_EVENTS, hours=24)


@query("dq_validity", """SELECT count(*) AS total_records, count(*) - count(signal_strength) AS null_signal_count,
    count(*) - count(data_usage_mb) AS null_usage_count, count(*) - count(device_id) AS null_device_count,
    (count(*) - count(*) FILTER (signal_strength IS NULL OR data_usage_mb IS NULL OR device_id IS NULL)) * 100.0 / count(*) AS validity_score
    FROM network_events WHERE event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR""", "validity_score")
def _(t):
    cols = {"null_signal_count": "signal_strength", "null_usage_count": "data_usage_mb", "null_device_count": "device_id"}
    return dq.dq_validity(t.network_events, AS_OF_EVENTS, cols, hours=240)


@query("dq_range_validation", """SELECT count(*) AS total_records,
    count(*) FILTER (energy_consumption BETWEEN 0.5 AND 5.0) AS valid_energy_range,
    count(*) FILTER (voltage BETWEEN 230 AND 240) AS valid_voltage_range,
    count(*) FILTER (current_reading BETWEEN 1.0 AND 15.0) AS valid_current_range,
    count(*) FILTER (power_factor BETWEEN 0.85 AND 0.99) AS valid_power_factor,
    count(*) FILTER (frequency BETWEEN 49.8 AND 50.2) AS valid_frequency,
    count(*) - count(meter_id) AS null_meter_ids, count(*) - count(timestamp) AS null_timestamps,
    count(*) - count(energy_consumption) AS null_energy, count(*) - count(voltage) AS null_voltage FROM meter_readings""")
def _(t):
    return dq.dq_range_validation(t.meter_readings)


@query("dq_etl_postcheck", f"""SELECT count(*) AS total_records, count(*) FILTER (energy_consumption > 0) AS valid_consumption,
    count(*) FILTER (voltage BETWEEN 200 AND 250) AS valid_voltage, CAST(sum(is_anomaly) AS BIGINT) AS anomalies
    FROM ({CLEAN}) WHERE date = DATE '2024-01-10'""")
def _(t):
    return dq.dq_etl_postcheck(clean(t), "2024-01-10")


@query("dq_issue_log", _each("""SELECT 'meter_readings' AS source, event_id AS key, '{0}' AS issue_type
    FROM meter_readings WHERE NOT coalesce({1}, FALSE)""", RULES_SQL.items()))
def _(t):
    return dq.dq_issue_log(t.meter_readings, "event_id", "meter_readings")


EXPECTED = {"click": 1000, "view": 2000, "refund": 5}


@query("dq_expected_vs_actual", """SELECT coalesce(e.event_type, a.event_type) AS event_type, coalesce(expected, 0) AS expected,
    coalesce(actual, 0) AS actual, coalesce(actual, 0) - coalesce(expected, 0) AS difference
    FROM (VALUES ('click', 1000), ('view', 2000), ('refund', 5)) AS e(event_type, expected)
    FULL JOIN (SELECT event_type, count(*) AS actual FROM events GROUP BY 1) AS a ON e.event_type = a.event_type""")
def _(t):
    return dq.dq_expected_vs_actual(t.events, EXPECTED, "event_type")


@query("union_all_literals", """SELECT 'Expected' AS description, CAST(2865 AS BIGINT) AS records
    UNION ALL SELECT 'Actual', count(*) FROM meter_readings""")
def _(t):
    return union_all_literals(t.meter_readings, 2865)


@query("union_all_literals__missing", """SELECT meter_id FROM (VALUES ('METER_001'), ('METER_002'), ('METER_X99')) AS e(meter_id)
    WHERE meter_id NOT IN (SELECT meter_id FROM meter_readings WHERE meter_id IS NOT NULL)""")
def _(t):
    return missing_ids(t.meter_readings, ["METER_001", "METER_002", "METER_X99"], "meter_id")


RULE = {"rule_name": "EXTENT", "rule_type": "GEOMETRY", "is_enabled": True, "bbox": (55.0, 24.8, 55.9, 25.2)}
OFF = {"rule_name": "OFF", "rule_type": "GEOMETRY", "is_enabled": False, "bbox": (0, 0, 1, 1)}


@query("feature_validate", """SELECT ingest_id, CASE WHEN source_system LIKE 'OSM_Dubai_Buildings%' THEN 'building'
    WHEN source_system LIKE 'OSM_Dubai_Roads%' THEN 'road' WHEN source_system LIKE 'OSM_Dubai_POIs%' THEN 'poi'
    WHEN source_system LIKE 'OSM_Dubai_Landuse%' THEN 'landuse' END AS feature_type, lon, lat FROM features
    WHERE lon IS NOT NULL AND lon > 55.0 AND lon < 55.9 AND lat > 24.8 AND lat < 25.2""", "lon lat")
def _(t):
    valid, _errors = dq.feature_validate(t.features, [RULE, OFF])
    return cl.classify_source_like(valid, "source_system").select("ingest_id", "feature_type", "lon", "lat")


@query("feature_validate__errors", """SELECT ingest_id, 'INVALID_GEOMETRY' AS error_code, 'Geometry invalid' AS error_msg
    FROM features WHERE lon IS NULL UNION ALL
    SELECT ingest_id, 'EXTENT', 'Geometry outside allowed extent' FROM features
    WHERE lon IS NOT NULL AND NOT (lon > 55.0 AND lon < 55.9 AND lat > 24.8 AND lat < 25.2)""")
def _(t):
    return dq.feature_validate(t.features, [RULE, OFF])[1]


@query("st_is_valid", """SELECT building_id, CASE building_id % 4 WHEN 1 THEN 'not closed' WHEN 2 THEN 'self intersection'
    WHEN 3 THEN 'too few points' END AS problem FROM building_geom""")
def _(t):
    from terrawatt.functions import geo

    c = {n: F.col(n) for n in ("minx", "miny", "maxx", "maxy")}
    ring = geo.st_rectangle(*c.values())
    p = lambda i: F.element_at(ring, i)
    bow = F.array(p(1), p(3), p(2), p(4), p(1))
    which = F.col("building_id") % 4
    broken = F.when(which == 1, F.slice(ring, 1, 4)).when(which == 2, bow).when(which == 3, F.slice(ring, 1, 3)).otherwise(ring)
    return t.building_geom.select("building_id", geo.ring_problem(broken).alias("problem"))
