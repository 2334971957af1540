"""Oracle SQL: remaining inventory items."""

from __future__ import annotations

from turnstile.plans.oracle import oracle, with_gold
from turnstile.plans.oracle_stage3 import _check
from turnstile.plans.oracle_stage5 import SLA_S
from turnstile.plans.oracle_views import with_views

oracle("p2_safe_casts", with_views("""
SELECT count(*) AS rows, count(*) FILTER (WHERE event_id % 50 <> 0) AS values_parsed,
  count(*) FILTER (WHERE event_id % 50 = 0) AS rejected_rows FROM events"""))
DEDUP = """
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY device_id, date ORDER BY _ingested_at DESC) AS rk
  FROM v_dirty_telemetry_all) d WHERE rk = 1"""
oracle("p13_health_daily", with_views("""
SELECT device_id, date, round(tap_success_rate * 30
  + (CASE WHEN signal_strength_dbm IS NULL THEN NULL ELSE least(greatest(signal_strength_dbm, 0), 100) END / 100) * 20
  + (1 - memory_usage_pct / 100) * 15 + (1 - cpu_usage_pct / 100) * 15
  + (CASE WHEN uptime_hours IS NULL THEN NULL ELSE least(greatest(uptime_hours, 0), 24) END / 24) * 10
  + (1 - least(greatest(error_count, 0), 10) / 10) * 10, 6)
  AS health_score FROM dd""", "v_dirty_telemetry_all", extra=[("dd", DEDUP)]))
oracle("w15_dbt_dedup", with_views("""
SELECT device_id, date, round(least(greatest(tap_success_rate, 0), 1.0), 6) AS tap_success_rate,
  round(cpu_usage_pct, 6) AS cpu_usage_pct FROM dd""", "v_dirty_telemetry_all", extra=[("dd", DEDUP)]))
oracle("p14_label_encode", with_views("""
SELECT device_id, manufacturer, CAST(dense_rank() OVER (ORDER BY manufacturer) - 1 AS INTEGER) AS manufacturer_code
FROM v_devices""", "v_devices"))
oracle("p24_sla_breach_flag", with_views(
    "SELECT maintenance_id, device_id, 1 - sla_met AS sla_breach FROM v_maintenance", "v_maintenance"))
DBT_ERR = """
SELECT device_id, CAST("timestamp" AS DATE) AS error_date, count(*) AS daily_error_events,
  count(DISTINCT error_code) AS unique_error_codes,
  max(CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4 ELSE 0 END)
    AS max_severity,
  CAST(sum(CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 1 ELSE 0 END) AS BIGINT) AS critical_errors
FROM v_errors GROUP BY 1, 2"""
oracle("a27_dbt_daily_errors", with_views("SELECT * FROM de", "v_errors", extra=[("de", DBT_ERR)]))
oracle("j12_dbt_daily_metrics", with_views("""
SELECT t.device_id, t.date AS reading_date, t.error_count, coalesce(e.daily_error_events, 0) AS daily_error_events,
  coalesce(e.unique_error_codes, 0) AS unique_error_codes, coalesce(e.max_severity, 0) AS max_severity,
  coalesce(e.critical_errors, 0) AS critical_errors
FROM v_telemetry t LEFT JOIN de e ON t.device_id = e.device_id AND t.date = e.error_date""",
    "v_telemetry", "v_errors", extra=[("de", DBT_ERR)]))

LATEST = """
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY date DESC) AS rk FROM gold) x
WHERE rk = 1"""
SCORE = f"SELECT device_id, round_even({SLA_S} * 10, 0) / 10 AS sla_risk_score, {SLA_S} AS s FROM latest"
oracle("t2_top_devices_by_sla", with_gold("""
SELECT device_id, round(sla_risk_score, 6) AS sla_risk_score,
  CASE WHEN s >= 70 THEN 'CRITICAL' WHEN s >= 50 THEN 'HIGH' WHEN s >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM sc ORDER BY sla_risk_score DESC, device_id LIMIT 5""", extra=[("latest", LATEST), ("sc", SCORE)]))
oracle("t5_highest_risk_device", with_gold("""
SELECT device_id, round(sla_risk_score, 6) AS sla_risk_score FROM sc
ORDER BY sla_risk_score DESC, device_id DESC LIMIT 1""", extra=[("latest", LATEST), ("sc", SCORE)]))
oracle("t2_top_transitions", with_views("""
SELECT from_error, to_error, round(round(p, 4), 6) AS probability, count FROM (
  SELECT from_error, to_error, count, count / sum(count) OVER (PARTITION BY from_error) AS p FROM (
    SELECT from_error, to_error, count(*) AS count FROM (
      SELECT error_code AS from_error, lead(error_code) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id)
        AS to_error FROM v_errors) t WHERE to_error IS NOT NULL GROUP BY 1, 2) c) x
WHERE p > 0.1 ORDER BY round(p, 4) DESC, count DESC, from_error, to_error LIMIT 10""", "v_errors"))
_sdm = "\nUNION ALL\n".join(
    f"SELECT date, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS m FROM gold GROUP BY date" for c in
    ["signal_strength_dbm", "temperature_c", "response_time_ms", "error_count", "tap_success_rate", "health_score"])
oracle("a23_spc_totals", with_gold("""
SELECT count(*) FILTER (WHERE m > ucl OR m < lcl) AS total_violations,
  count(*) FILTER (WHERE (m > uwl AND m <= ucl) OR (m < lwl AND m >= lcl)) AS total_warnings
FROM dm JOIN (SELECT feature, avg(m) + 3 * stddev_samp(m) AS ucl, avg(m) - 3 * stddev_samp(m) AS lcl,
                     avg(m) + 2 * stddev_samp(m) AS uwl, avg(m) - 2 * stddev_samp(m) AS lwl
              FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY date) AS rn FROM dm) b
              WHERE rn <= 7 GROUP BY feature) l USING (feature)""", extra=[("dm", _sdm)]))

_q13 = [
    _check("dbt", "device_features", "gold", 0, "not_null(device_id, 1.0)",
           "(1 - avg(CASE WHEN device_id IS NULL THEN 1.0 ELSE 0.0 END)) >= 1.0",
           "avg(CASE WHEN device_id IS NULL THEN 1.0 ELSE 0.0 END)"),
    _check("dbt", "device_features", "gold", 1, "not_null(date, 1.0)",
           "(1 - avg(CASE WHEN date IS NULL THEN 1.0 ELSE 0.0 END)) >= 1.0",
           "avg(CASE WHEN date IS NULL THEN 1.0 ELSE 0.0 END)"),
    _check("dbt", "device_features", "gold", 2, "not_null(health_score, 1.0)",
           "(1 - avg(CASE WHEN health_score IS NULL THEN 1.0 ELSE 0.0 END)) >= 1.0",
           "avg(CASE WHEN health_score IS NULL THEN 1.0 ELSE 0.0 END)"),
    _check("dbt", "device_features", "gold", 3, "between(health_score, 0, 100)",
           "coalesce(min(health_score) >= 0.0 AND max(health_score) <= 100.0, FALSE)", "max(health_score)"),
    _check("dbt", "device_features", "gold", 4, "not_null(signal_strength_dbm_7d_mean, 1.0)",
           "(1 - avg(CASE WHEN signal_strength_dbm_7d_mean IS NULL THEN 1.0 ELSE 0.0 END)) >= 1.0",
           "avg(CASE WHEN signal_strength_dbm_7d_mean IS NULL THEN 1.0 ELSE 0.0 END)"),
    _check("dbt", "device_features", "gold", 5, "between(signal_strength_dbm_7d_mean, 0, 100)",
           "coalesce(min(signal_strength_dbm_7d_mean) >= 0.0 AND max(signal_strength_dbm_7d_mean) <= 100.0, FALSE)",
           "max(signal_strength_dbm_7d_mean)"),
    _check("dbt", "device_features", "gold", 6, "not_null(failure_next_3d, 1.0)",
           "(1 - avg(CASE WHEN failure_next_3d IS NULL THEN 1.0 ELSE 0.0 END)) >= 1.0",
           "avg(CASE WHEN failure_next_3d IS NULL THEN 1.0 ELSE 0.0 END)"),
    _check("dbt", "device_features", "gold", 7, "in_set(failure_next_3d, (0, 1))",
           "count(*) FILTER (WHERE failure_next_3d IS NOT NULL AND failure_next_3d NOT IN (0, 1)) = 0",
           "count(*) FILTER (WHERE failure_next_3d IS NOT NULL AND failure_next_3d NOT IN (0, 1))"),
    _check("dbt", "device_features", "gold", 8, "mean_between(failure_next_3d, 0.02, 0.15)",
           "coalesce(avg(CAST(failure_next_3d AS DOUBLE)) BETWEEN 0.02 AND 0.15, FALSE)",
           "avg(CAST(failure_next_3d AS DOUBLE))"),
    _check("dbt", "device_features", "(SELECT max(c) AS m FROM (SELECT count(*) AS c FROM gold GROUP BY device_id, date) k)",
           9, "unique(device_id, date)", "max(m) = 1", "max(m)"),
]
oracle("q13_dbt_tests", with_gold("\nUNION ALL\n".join(_q13)))
oracle("c10_idempotent_write", with_views("SELECT date, count(*) AS rows FROM v_telemetry GROUP BY 1", "v_telemetry"))
oracle("s7_watermarked_ingest", with_views("""
SELECT 1 AS run, 'first_load' AS action UNION ALL SELECT 2, 'skip' UNION ALL SELECT 3, 'reprocess'"""))
oracle("b14_predictions_vs_outcomes", with_gold(f"""
SELECT risk_tier, count(*) AS predictions, round(avg(CAST(f AS DOUBLE)), 6) AS precision FROM (
  SELECT CASE WHEN s >= 70 THEN 'CRITICAL' WHEN s >= 50 THEN 'HIGH' WHEN s >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
    CASE WHEN EXISTS (SELECT 1 FROM gold b WHERE b.device_id = a.device_id AND b.failure_today = 1
                      AND b.date BETWEEN a.date + 1 AND a.date + 7) THEN 1 ELSE 0 END AS f
  FROM (SELECT *, {SLA_S} AS s FROM gold) a) x GROUP BY 1"""))
oracle("b16_monthly_report", with_gold("""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(DISTINCT device_id) AS devices, count(*) AS device_days,
  CAST(sum(failure_today) AS BIGINT) AS failures, round(avg(health_score), 6) AS mean_health,
  CAST(sum(error_count) AS BIGINT) AS errors FROM gold GROUP BY 1"""))
oracle("a26_daily_sla_summary", with_gold(f"""
SELECT date, count(*) FILTER (WHERE s >= 70) AS critical_devices, count(*) FILTER (WHERE s >= 50 AND s < 70) AS high_devices,
  count(*) FILTER (WHERE s >= 30 AND s < 50) AS medium_devices, count(*) FILTER (WHERE s < 30) AS low_devices,
  round(avg(greatest(1, CAST(floor(90 * (1 - s / 100)) AS INTEGER))), 6) AS mean_rul
FROM (SELECT date, {SLA_S} AS s FROM gold) x GROUP BY date"""))
from turnstile.plans import oracle_stage8  # noqa: E402,F401
