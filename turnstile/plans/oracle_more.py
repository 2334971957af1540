"""Oracle SQL for the silver layer and later stages."""

from __future__ import annotations

from turnstile.plans.oracle import oracle
from turnstile.plans.oracle_views import with_views


def sql_title(x: str) -> str:
    """Python str.title() for words split on '_' and blanks (DuckDB lambdas)."""
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), '_'), lambda p: "
            f"array_to_string(list_transform(string_split(p, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')), '_')")


def clip(x: str, lo, hi) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest({x}, {lo}), {hi}) END"


DEDUP_T = """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id, date ORDER BY _ingested_at DESC) AS rk
  FROM v_dirty_telemetry_all) d WHERE rk = 1
"""
oracle("w7_dedup_latest", with_views("""
SELECT device_id, date, round(cpu_usage_pct, 6) AS cpu_usage_pct, round(signal_strength_dbm, 6) AS signal_strength_dbm
FROM dedup""", "v_dirty_telemetry_all", extra=[("dedup", DEDUP_T)]))

oracle("w8_exact_dedup", with_views("""
SELECT DISTINCT device_id, "timestamp", event_id, error_code, severity, resolved,
  round(resolution_time_min, 6) AS resolution_time_min
FROM (SELECT * FROM v_errors UNION ALL SELECT * FROM v_errors WHERE event_id % 4 = 0) u""", "v_errors"))

DEDUP_D = """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY _ingested_at DESC) AS rk
  FROM v_dirty_devices) d WHERE rk = 1
"""
oracle("p3_standardise_text", with_views(f"""
SELECT device_id, {sql_title('station')} AS station, {sql_title('gate_type')} AS gate_type,
  {sql_title('manufacturer')} AS manufacturer,
  CAST({clip('age_days', 0, 3650)} AS INTEGER) AS age_days,
  CAST({clip('warranty_remaining_days', 0, 1825)} AS INTEGER) AS warranty_remaining_days
FROM dedup_d""", "v_dirty_devices", extra=[("dedup_d", DEDUP_D)]))

T_RANGES = {
    "tap_success_rate": (0.0, 1.0), "signal_strength_dbm": (0.0, 100.0), "temperature_c": (-10.0, 80.0),
    "response_time_ms": (10.0, 5000.0), "network_latency_ms": (1.0, 1000.0), "power_voltage": (2.0, 6.0),
    "memory_usage_pct": (0.0, 100.0), "cpu_usage_pct": (0.0, 100.0), "error_count": (0, 100),
    "reboot_count": (0, 50), "uptime_hours": (0.0, 24.0),
}
T_COLS = ["daily_taps", "tap_success_rate", "signal_strength_dbm", "temperature_c", "response_time_ms",
          "network_latency_ms", "power_voltage", "memory_usage_pct", "cpu_usage_pct", "error_count",
          "reboot_count", "uptime_hours", "failure_today"]
T_INT = {"daily_taps", "error_count", "reboot_count", "failure_today"}


def _clipped_sel():
    out = []
    for c in T_COLS:
        if c in T_RANGES:
            lo, hi = T_RANGES[c]
            e = clip(c, f"CAST({lo} AS DOUBLE)" if c not in T_INT else lo, f"CAST({hi} AS DOUBLE)" if c not in T_INT else hi)
            out.append(f"CAST({e} AS {'INTEGER' if c in T_INT else 'DOUBLE'}) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


CLIPPED = f"SELECT device_id, date, {_clipped_sel()} FROM dedup"
oracle("p4_clip", with_views(
    "SELECT device_id, date, " + ", ".join(c if c in T_INT else f"round({c}, 6) AS {c}" for c in T_COLS) + " FROM clipped",
    "v_dirty_telemetry_all", extra=[("dedup", DEDUP_T), ("clipped", CLIPPED)]))

MEDS = "SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in T_COLS) + " FROM clipped"
_fill = ", ".join(
    (f"CAST(coalesce({c}, m_{c}) AS INTEGER) AS {c}" if c in T_INT else f"round(coalesce({c}, m_{c}), 6) AS {c}")
    for c in T_COLS)
oracle("p6_silver_telemetry", with_views(
    f"SELECT device_id, date, {_fill} FROM clipped, meds", "v_dirty_telemetry_all",
    extra=[("dedup", DEDUP_T), ("clipped", CLIPPED), ("meds", MEDS)]))

oracle("p5_silver_error_logs", with_views("""
SELECT device_id, "timestamp", event_id, error_code, severity, resolved,
  round(coalesce(resolution_time_min, -1), 6) AS resolution_time_min
FROM (SELECT device_id, "timestamp", event_id, trim(upper(error_code)) AS error_code,
             trim(upper(severity)) AS severity, resolved, resolution_time_min FROM v_dirty_errors) s
WHERE severity IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')""", "v_dirty_errors"))

oracle("p7_silver_maintenance", with_views(f"""
SELECT device_id, date, {sql_title('maintenance_type')} AS maintenance_type, issue_description, sla_target_hours,
  round({clip('actual_resolution_hours', 'CAST(0 AS DOUBLE)', 'CAST(168 AS DOUBLE)')}, 6) AS actual_resolution_hours,
  sla_met, round({clip('cost_gbp', 'CAST(0 AS DOUBLE)', 'CAST(10000 AS DOUBLE)')}, 6) AS cost_gbp,
  technician_id, parts_replaced, maintenance_id
FROM v_dirty_maintenance""", "v_dirty_maintenance"))

oracle("q12_quarantine", with_views("""
SELECT event_id, device_id,
  CASE WHEN NOT sev_ok THEN 'severity_in_set' ELSE 'resolution_time_present' END AS rejection_rule,
  CASE WHEN NOT sev_ok AND NOT res_ok THEN 'severity not in LOW/MEDIUM/HIGH/CRITICAL; resolution_time_min is NULL'
       WHEN NOT sev_ok THEN 'severity not in LOW/MEDIUM/HIGH/CRITICAL'
       ELSE 'resolution_time_min is NULL' END AS rejection_reason,
  CAST(CASE WHEN NOT sev_ok THEN 1 ELSE 0 END + CASE WHEN NOT res_ok THEN 1 ELSE 0 END AS INTEGER) AS failed_rules
FROM (SELECT *, trim(upper(severity)) IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL') AS sev_ok,
             resolution_time_min IS NOT NULL AS res_ok FROM v_dirty_errors) s
WHERE NOT sev_ok OR NOT res_ok""", "v_dirty_errors"))

oracle("j14_orphans", with_views("""
SELECT o_orderkey AS maintenance_id, o_custkey AS device_id FROM orders
WHERE o_custkey NOT IN (SELECT device_id FROM v_devices)""", "v_devices"))

oracle("b4_null_rules", with_views("""
SELECT device_id, date,
  round(coalesce(signal_strength_dbm, (SELECT median(signal_strength_dbm) FROM valid)), 6) AS signal_strength_dbm,
  round(response_time_ms, 6) AS response_time_ms
FROM valid""", "v_dirty_telemetry_all",
    extra=[("dedup", DEDUP_T), ("valid", "SELECT * FROM dedup WHERE response_time_ms IS NOT NULL")]))

oracle("b5_enum_map", with_views("""
SELECT CASE trim(maintenance_type) WHEN 'preventive' THEN 'Preventive' WHEN 'corrective' THEN 'Corrective'
         WHEN 'emergency' THEN 'Emergency' WHEN 'firmware_update' THEN 'Firmware_Update'
         ELSE maintenance_type END AS maintenance_type, count(*) AS n
FROM v_dirty_maintenance GROUP BY 1""", "v_dirty_maintenance"))


from turnstile.plans import oracle_stage3  # noqa: E402,F401
