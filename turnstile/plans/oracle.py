"""DuckDB oracle SQL for the registered queries (independent formulations).

Doubles are rounded to 6 digits, counts cast to the Spark type, every
computed column aliased to the Spark column name.
"""

from __future__ import annotations

from turnstile.plans.oracle_views import with_views

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str):
    ORACLE[name] = sql


ROLL = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms",
        "error_count", "tap_success_rate", "memory_usage_pct", "cpu_usage_pct"]
DELTA = ["signal_strength_dbm", "temperature_c", "error_count", "response_time_ms"]
W = "PARTITION BY device_id ORDER BY date"
W7 = f"({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
RUN = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _mean(c):
    return f"round(avg({c}) OVER {W7}, 6) AS {c}_7d_mean"


def _std(c):
    return f"round(coalesce(stddev_samp({c}) OVER {W7}, 0), 6) AS {c}_7d_std"


def _delta(c):
    return f"round(coalesce({c} - lag({c}) OVER ({W}), 0), 6) AS {c}_delta"


oracle("w1_rolling_mean", with_views(
    f"SELECT device_id, date, {', '.join(_mean(c) for c in ROLL)} FROM v_telemetry", "v_telemetry"))
oracle("w2_rolling_std", with_views(
    f"SELECT device_id, date, {', '.join(_std(c) for c in ROLL)} FROM v_telemetry", "v_telemetry"))
oracle("w3_delta", with_views(
    f"SELECT device_id, date, {', '.join(_delta(c) for c in DELTA)} FROM v_telemetry", "v_telemetry"))
oracle("w4_cumulative", with_views(f"""
SELECT device_id, date,
  CAST(sum(error_count) OVER {RUN} AS BIGINT) AS cumulative_errors,
  CAST(sum(reboot_count) OVER {RUN} AS BIGINT) AS cumulative_reboots,
  CAST(sum(failure_today) OVER {RUN} AS BIGINT) AS failure_cumsum
FROM v_telemetry""", "v_telemetry"))
oracle("w5_days_since_failure", with_views(f"""
SELECT device_id, date, failure_cumsum,
  CAST(row_number() OVER (PARTITION BY device_id, failure_cumsum ORDER BY date) - 1 AS INTEGER) AS days_since_last_failure
FROM (SELECT device_id, date, CAST(sum(failure_today) OVER {RUN} AS BIGINT) AS failure_cumsum FROM v_telemetry) c
""", "v_telemetry"))
oracle("w6_failure_next_3d", with_views(f"""
SELECT device_id, date,
  CAST(CASE WHEN lead(failure_today) OVER ({W}) IS NULL THEN 0
       ELSE max(failure_today) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS INTEGER) AS failure_next_3d
FROM v_telemetry""", "v_telemetry"))

HEALTH = """round_even(100 * (tap_success_rate * 30 + (signal_strength_dbm / 100) * 20 + (1 - memory_usage_pct / 100) * 15
  + (1 - cpu_usage_pct / 100) * 15 + (uptime_hours / 24) * 10
  + (1 - least(greatest(error_count, 0), 10) / 10) * 10), 0) / 100"""
oracle("p12_health_score", with_views(
    f"SELECT device_id, date, round({HEALTH}, 6) AS health_score FROM v_telemetry", "v_telemetry"))

ERR_DAY = """
SELECT device_id, CAST("timestamp" AS DATE) AS date,
  CAST(count(*) FILTER (WHERE severity = 'LOW') AS INTEGER) AS error_low_count,
  CAST(count(*) FILTER (WHERE severity = 'MEDIUM') AS INTEGER) AS error_medium_count,
  CAST(count(*) FILTER (WHERE severity = 'HIGH') AS INTEGER) AS error_high_count,
  CAST(count(*) FILTER (WHERE severity = 'CRITICAL') AS INTEGER) AS error_critical_count,
  CAST(count(DISTINCT error_code) AS INTEGER) AS unique_error_types,
  avg(CAST(resolved AS DOUBLE)) AS error_resolution_rate
FROM v_errors GROUP BY device_id, CAST("timestamp" AS DATE)
"""
TOP_CODE = """
SELECT device_id, date, error_code AS top_error_code FROM (
  SELECT device_id, date, error_code,
         row_number() OVER (PARTITION BY device_id, date ORDER BY n DESC, error_code) AS rk
  FROM (SELECT device_id, CAST("timestamp" AS DATE) AS date, error_code, count(*) AS n
        FROM v_errors GROUP BY 1, 2, 3) c) r
WHERE rk = 1
"""
oracle("a1_severity_pivot", with_views(
    "SELECT device_id, date, error_low_count, error_medium_count, error_high_count, error_critical_count FROM err_day",
    "v_errors", extra=[("err_day", ERR_DAY)]))
oracle("a2_mode", with_views("SELECT * FROM top_code", "v_errors", extra=[("top_code", TOP_CODE)]))
oracle("a3_distinct_codes", with_views(
    "SELECT device_id, date, unique_error_types FROM err_day", "v_errors", extra=[("err_day", ERR_DAY)]))
oracle("a4_resolution_rate", with_views(
    "SELECT device_id, date, round(error_resolution_rate, 6) AS error_resolution_rate FROM err_day",
    "v_errors", extra=[("err_day", ERR_DAY)]))

MAINT_AGG = """
SELECT device_id,
  count(date) AS total_maintenance_count,
  count(*) FILTER (WHERE maintenance_type = 'Corrective') AS corrective_count,
  count(*) FILTER (WHERE maintenance_type = 'Emergency') AS emergency_count,
  avg(actual_resolution_hours) AS avg_resolution_hours,
  avg(CAST(sla_met AS DOUBLE)) AS sla_compliance_rate,
  sum(cost_gbp) AS total_cost_gbp,
  CAST(sum(parts_replaced) AS BIGINT) AS parts_replaced_count
FROM v_maintenance GROUP BY device_id
"""
oracle("a5_maintenance_rollup", with_views("""
SELECT device_id, total_maintenance_count, corrective_count, emergency_count,
  round(avg_resolution_hours, 6) AS avg_resolution_hours, round(sla_compliance_rate, 6) AS sla_compliance_rate,
  round(total_cost_gbp, 6) AS total_cost_gbp, parts_replaced_count FROM maint_agg""",
    "v_maintenance", extra=[("maint_agg", MAINT_AGG)]))

J1_BODY = """
SELECT t.device_id, t.date, t.error_count,
  coalesce(e.error_low_count, 0) AS error_low_count, coalesce(e.error_medium_count, 0) AS error_medium_count,
  coalesce(e.error_high_count, 0) AS error_high_count, coalesce(e.error_critical_count, 0) AS error_critical_count,
  coalesce(c.top_error_code, 'NONE') AS top_error_code,
  coalesce(e.unique_error_types, 0) AS unique_error_types,
  round(coalesce(e.error_resolution_rate, 0), 6) AS error_resolution_rate
FROM v_telemetry t
LEFT JOIN err_day e ON t.device_id = e.device_id AND t.date = e.date
LEFT JOIN top_code c ON t.device_id = c.device_id AND t.date = c.date
"""
oracle("j1_error_join", with_views(J1_BODY, "v_telemetry", "v_errors",
                                   extra=[("err_day", ERR_DAY), ("top_code", TOP_CODE)]))
oracle("j2_maintenance_join", with_views("""
SELECT t.device_id, t.date,
  coalesce(m.total_maintenance_count, 0) AS total_maintenance_count,
  coalesce(m.corrective_count, 0) AS corrective_count, coalesce(m.emergency_count, 0) AS emergency_count,
  round(coalesce(m.avg_resolution_hours, 0), 6) AS avg_resolution_hours,
  round(coalesce(m.sla_compliance_rate, 0), 6) AS sla_compliance_rate,
  round(coalesce(m.total_cost_gbp, 0), 6) AS total_cost_gbp,
  coalesce(m.parts_replaced_count, 0) AS parts_replaced_count
FROM v_telemetry t LEFT JOIN maint_agg m ON t.device_id = m.device_id""",
    "v_telemetry", "v_maintenance", extra=[("maint_agg", MAINT_AGG)]))

FLAGS = """
CASE WHEN d.age_days > 1000 THEN 1 ELSE 0 END AS is_old_device,
CASE WHEN d.firmware_version = 'v4.0.0-beta' THEN 1 ELSE 0 END AS is_beta_firmware,
CASE WHEN d.warranty_remaining_days > 0 THEN 1 ELSE 0 END AS is_under_warranty,
CASE WHEN d.station IN ('Kings Cross', 'Victoria', 'Waterloo', 'Oxford Circus', 'Bank', 'Canary Wharf',
  'Liverpool Street') THEN 1 ELSE 0 END AS is_high_traffic_station"""
oracle("j3_device_join", with_views(f"""
SELECT t.device_id, t.date, d.station, d.gate_type, d.manufacturer, d.firmware_version, d.age_days,
  d.warranty_remaining_days, d.failure_prone, {FLAGS}
FROM v_telemetry t LEFT JOIN v_devices d ON t.device_id = d.device_id""", "v_telemetry", "v_devices"))

GOLD_BODY = f"""
SELECT t.*,
  coalesce(e.error_low_count, 0) AS error_low_count, coalesce(e.error_medium_count, 0) AS error_medium_count,
  coalesce(e.error_high_count, 0) AS error_high_count, coalesce(e.error_critical_count, 0) AS error_critical_count,
  coalesce(c.top_error_code, 'NONE') AS top_error_code,
  coalesce(e.unique_error_types, 0) AS unique_error_types,
  coalesce(e.error_resolution_rate, 0) AS error_resolution_rate,
  coalesce(m.total_maintenance_count, 0) AS total_maintenance_count,
  coalesce(m.corrective_count, 0) AS corrective_count, coalesce(m.emergency_count, 0) AS emergency_count,
  coalesce(m.avg_resolution_hours, 0) AS avg_resolution_hours,
  coalesce(m.sla_compliance_rate, 0) AS sla_compliance_rate,
  coalesce(m.total_cost_gbp, 0) AS total_cost_gbp,
  coalesce(m.parts_replaced_count, 0) AS parts_replaced_count,
  d.station, d.gate_type, d.manufacturer, d.firmware_version, d.age_days, d.warranty_remaining_days,
  d.failure_prone, {FLAGS}
FROM v_telemetry t
LEFT JOIN err_day e ON t.device_id = e.device_id AND t.date = e.date
LEFT JOIN top_code c ON t.device_id = c.device_id AND t.date = c.date
LEFT JOIN maint_agg m ON t.device_id = m.device_id
LEFT JOIN v_devices d ON t.device_id = d.device_id
"""
GOLD_COLS = ("device_id, date, daily_taps, tap_success_rate, signal_strength_dbm, temperature_c, response_time_ms, "
             "network_latency_ms, power_voltage, memory_usage_pct, cpu_usage_pct, error_count, reboot_count, "
             "uptime_hours, failure_today, error_low_count, error_medium_count, error_high_count, "
             "error_critical_count, top_error_code, unique_error_types, error_resolution_rate, "
             "total_maintenance_count, corrective_count, emergency_count, avg_resolution_hours, "
             "sla_compliance_rate, total_cost_gbp, parts_replaced_count, station, gate_type, manufacturer, "
             "firmware_version, age_days, warranty_remaining_days, failure_prone, is_old_device, "
             "is_beta_firmware, is_under_warranty, is_high_traffic_station")


def _r(col):
    return f"round({col}, 6) AS {col}"


GOLD_DOUBLES = {"tap_success_rate", "signal_strength_dbm", "temperature_c", "response_time_ms",
                "network_latency_ms", "power_voltage", "memory_usage_pct", "cpu_usage_pct", "uptime_hours",
                "error_resolution_rate", "avg_resolution_hours", "sla_compliance_rate", "total_cost_gbp"}
_gold_sel = ", ".join(_r(c) if c in GOLD_DOUBLES else c for c in GOLD_COLS.split(", "))


def gold_sql(rounded: bool = True) -> str:
    """Body of the gold table (needs CTEs err_day, top_code, maint_agg, base)."""
    sel = _gold_sel if rounded else GOLD_COLS
    mean = (lambda c: _mean(c)) if rounded else (lambda c: f"avg({c}) OVER {W7} AS {c}_7d_mean")
    std = (lambda c: _std(c)) if rounded else (lambda c: f"coalesce(stddev_samp({c}) OVER {W7}, 0) AS {c}_7d_std")
    delta = (lambda c: _delta(c)) if rounded else (lambda c: f"coalesce({c} - lag({c}) OVER ({W}), 0) AS {c}_delta")
    health = f"round({HEALTH}, 6)" if rounded else HEALTH
    return f"""
SELECT {sel},
  {', '.join(mean(c) for c in ROLL)},
  {', '.join(std(c) for c in ROLL)},
  {', '.join(delta(c) for c in DELTA)},
  CAST(sum(error_count) OVER {RUN} AS BIGINT) AS cumulative_errors,
  CAST(sum(reboot_count) OVER {RUN} AS BIGINT) AS cumulative_reboots,
  failure_cumsum,
  CAST(row_number() OVER (PARTITION BY device_id, failure_cumsum ORDER BY date) - 1 AS INTEGER) AS days_since_last_failure,
  {health} AS health_score,
  CAST(CASE WHEN lead(failure_today) OVER ({W}) IS NULL THEN 0
       ELSE max(failure_today) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS INTEGER) AS failure_next_3d,
  CAST(coalesce((SELECT max(x.failure_today) FROM v_telemetry x WHERE x.device_id = g.device_id
     AND x.date BETWEEN g.date + 1 AND g.date + 3), 0) AS INTEGER) AS failure_within_3d
FROM (SELECT *, CAST(sum(failure_today) OVER {RUN} AS BIGINT) AS failure_cumsum FROM base) g
"""


GOLD_VIEWS = ("v_telemetry", "v_errors", "v_maintenance", "v_devices")
GOLD_EXTRA = [("err_day", ERR_DAY), ("top_code", TOP_CODE), ("maint_agg", MAINT_AGG), ("base", GOLD_BODY)]


def with_gold(body: str, *more_views: str, extra=None) -> str:
    """``WITH <views>, gold AS (<unrounded gold>) <body>``."""
    return with_views(body, *GOLD_VIEWS, *more_views, extra=GOLD_EXTRA + [("gold", gold_sql(False))] + (extra or []))


oracle("gold_features", with_views(gold_sql(True), *GOLD_VIEWS, extra=GOLD_EXTRA))


def _multi(c, n):
    fr = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (f"round(avg({c}) OVER {fr}, 6) AS {c}_{n}d_mean, "
            f"round(coalesce(stddev_samp({c}) OVER {fr}, 0), 6) AS {c}_{n}d_std, "
            f"min({c}) OVER {fr} AS {c}_{n}d_min, max({c}) OVER {fr} AS {c}_{n}d_max")


_b6 = ", ".join(_multi(c, n) for n in (7, 14, 30) for c in ("response_time_ms", "error_count"))
oracle("b6_rolling_multi", with_views(f"SELECT device_id, date, {_b6} FROM v_telemetry", "v_telemetry"))
oracle("b7_calendar", with_views("""
SELECT device_id, date,
  CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter,
  CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring'
       WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
FROM v_telemetry""", "v_telemetry"))
oracle("b8_maintenance_windows", with_views("""
SELECT a.maintenance_id, a.device_id, a.date,
  round((SELECT sum(b.cost_gbp) FROM v_maintenance b WHERE b.device_id = a.device_id
         AND b.date BETWEEN a.date - 29 AND a.date), 6) AS cost_30d,
  CAST(row_number() OVER (PARTITION BY a.device_id ORDER BY a.date, a.maintenance_id) AS BIGINT) AS running_maintenance_count
FROM v_maintenance a""", "v_maintenance"))
oracle("b9_failure_within_3d", with_views("""
SELECT a.device_id, a.date,
  CASE WHEN EXISTS (SELECT 1 FROM v_telemetry b WHERE b.device_id = a.device_id
       AND b.date BETWEEN a.date + 1 AND a.date + 3 AND b.failure_today = 1) THEN 1 ELSE 0 END AS failure_within_3d
FROM v_telemetry a""", "v_telemetry"))
oracle("j13_dbt_label", with_views("""
SELECT a.device_id, a.date,
  CASE WHEN EXISTS (SELECT 1 FROM v_telemetry b WHERE b.device_id = a.device_id
       AND b.date > a.date AND b.date <= a.date + INTERVAL 3 DAY AND b.error_count >= 5) THEN 1 ELSE 0 END AS will_fail_3d
FROM v_telemetry a""", "v_telemetry"))
oracle("w14_dbt_rolling", with_views(f"""
SELECT device_id, date,
  round(avg(response_time_ms) OVER {W7}, 6) AS response_time_ms_rolling_avg,
  round(stddev_samp(response_time_ms) OVER {W7}, 6) AS response_time_ms_rolling_std,
  error_count - lag(error_count) OVER ({W}) AS error_count_delta,
  CAST(sum(error_count) OVER {RUN} AS BIGINT) AS error_count_running
FROM v_telemetry""", "v_telemetry"))


def all_oracles() -> dict[str, str]:
    from turnstile.plans import oracle_more, oracle_stage9  # noqa: F401
    return dict(ORACLE)
