"""DuckDB SQL for the canonical views (independent of the Spark code path).

Used only by the SQL oracle: each oracle query is ``WITH <views> <body>``.
Every fractional literal is written as DOUBLE (a bare ``1.0`` is DECIMAL).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def view(name: str, sql: str, deps=()):
    VIEWS[name] = sql
    DEPS[name] = list(deps)


view("v_telemetry", """
SELECT device_id, date,
  CAST(n AS INTEGER) AS daily_taps,
  CAST(1 AS DOUBLE) - n_err / n AS tap_success_rate,
  least(CAST(100 AS DOUBLE), avg_v) AS signal_strength_dbm,
  CAST(20 AS DOUBLE) + avg_v / 5 AS temperature_c,
  max_v AS response_time_ms,
  min_v AS network_latency_ms,
  CAST(5 AS DOUBLE) - CAST(0.1 AS DOUBLE) * n_err AS power_voltage,
  least(CAST(100 AS DOUBLE), max_v / 5) AS memory_usage_pct,
  least(CAST(100 AS DOUBLE), avg_v) AS cpu_usage_pct,
  CAST(n_err AS INTEGER) AS error_count,
  CAST(n_signup AS INTEGER) AS reboot_count,
  CAST(24 AS DOUBLE) - n_err AS uptime_hours,
  CASE WHEN n_err >= 2 THEN 1 ELSE 0 END AS failure_today
FROM (
  SELECT user_id AS device_id, CAST(ts AS DATE) AS date, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'error') AS n_err,
         count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
         avg(value) AS avg_v, max(value) AS max_v, min(value) AS min_v
  FROM events GROUP BY user_id, CAST(ts AS DATE)) g
""")

view("v_errors", """
SELECT user_id AS device_id, ts AS "timestamp", event_id,
  upper(event_type) AS error_code,
  CASE WHEN value < 15 THEN 'LOW' WHEN value < 35 THEN 'MEDIUM'
       WHEN value < 70 THEN 'HIGH' ELSE 'CRITICAL' END AS severity,
  CASE WHEN event_id % 7 <> 0 THEN 1 ELSE 0 END AS resolved,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS resolution_time_min
FROM events
""")

view("v_devices", """
SELECT c_custkey AS device_id, n_name AS station,
  CASE c_custkey % 4 WHEN 0 THEN 'Entry' WHEN 1 THEN 'Exit' WHEN 2 THEN 'Wide_Entry' ELSE 'Wide_Exit' END AS gate_type,
  c_mktsegment AS manufacturer,
  CASE c_custkey % 4 WHEN 0 THEN 'v3.1.0' WHEN 1 THEN 'v3.2.1' WHEN 2 THEN 'v3.3.0' ELSE 'v4.0.0-beta' END AS firmware_version,
  CAST(DATE '2024-01-01' - CAST((c_custkey * 37) % 1800 AS INTEGER) AS DATE) AS install_date,
  CAST((c_custkey * 37) % 1800 AS INTEGER) AS age_days,
  greatest(0, 730 - CAST((c_custkey * 37) % 1800 AS INTEGER)) AS warranty_remaining_days,
  CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS failure_prone
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey IN (SELECT user_id FROM events)
""")

view("v_maintenance", """
SELECT device_id, date, maintenance_type, issue_description, sla_target_hours,
  actual_resolution_hours,
  CASE WHEN actual_resolution_hours <= sla_target_hours THEN 1 ELSE 0 END AS sla_met,
  cost_gbp, technician_id, parts_replaced, maintenance_id
FROM (
  SELECT o_custkey AS device_id, CAST(o_orderdate AS DATE) AS date, mt AS maintenance_type,
    o_orderstatus AS issue_description,
    CASE mt WHEN 'Emergency' THEN 4 WHEN 'Corrective' THEN 8 ELSE 24 END AS sla_target_hours,
    CAST(o_orderkey % 30 AS DOUBLE) AS actual_resolution_hours,
    o_totalprice / 100 AS cost_gbp,
    'T' || CAST(o_orderkey % 20 AS VARCHAR) AS technician_id,
    CAST(o_orderkey % 2 AS INTEGER) AS parts_replaced,
    o_orderkey AS maintenance_id
  FROM (SELECT *, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Emergency' WHEN '2' THEN 'Corrective'
                   WHEN '3' THEN 'Corrective' WHEN '4' THEN 'Preventive' ELSE 'Firmware_Update' END AS mt
        FROM orders WHERE o_custkey IN (SELECT user_id FROM events)) o) m
""")

view("v_requests", """
SELECT event_id, ts, user_id AS device_id, event_type AS name, value AS duration_ms,
  event_type <> 'error' AS success
FROM events
""")

# dirty variants: same planted defects as turnstile.sources.canonical
view("v_dirty_telemetry", """
SELECT * FROM (
  SELECT device_id, date, daily_taps, tap_success_rate,
    CASE WHEN k % 11 = 0 THEN NULL ELSE signal_strength_dbm END AS signal_strength_dbm,
    CASE WHEN k % 13 = 0 THEN CAST(150 AS DOUBLE) ELSE temperature_c END AS temperature_c,
    CASE WHEN k % 17 = 0 THEN NULL ELSE response_time_ms END AS response_time_ms,
    network_latency_ms, power_voltage, memory_usage_pct, cpu_usage_pct, error_count, reboot_count,
    CASE WHEN k % 19 = 0 THEN CAST(-5 AS DOUBLE) ELSE uptime_hours END AS uptime_hours,
    failure_today, CAST(date AS TIMESTAMP) + INTERVAL 6 HOUR AS _ingested_at, k
  FROM (SELECT *, device_id * 31 + day(date) AS k FROM v_telemetry) t) a
""", ["v_telemetry"])

view("v_dirty_telemetry_all", """
SELECT device_id, date, daily_taps, tap_success_rate, signal_strength_dbm, temperature_c, response_time_ms,
  network_latency_ms, power_voltage, memory_usage_pct, cpu_usage_pct, error_count, reboot_count,
  uptime_hours, failure_today, _ingested_at FROM v_dirty_telemetry
UNION ALL
SELECT device_id, date, daily_taps, tap_success_rate, signal_strength_dbm, temperature_c, response_time_ms,
  network_latency_ms, power_voltage, memory_usage_pct, cpu_usage_pct + 1, error_count, reboot_count,
  uptime_hours, failure_today, _ingested_at + INTERVAL 1 HOUR FROM v_dirty_telemetry WHERE k % 5 = 0
""", ["v_dirty_telemetry"])

view("v_dirty_errors", """
SELECT device_id, "timestamp", event_id,
  CASE WHEN event_id % 6 = 1 THEN lower(error_code) || ' ' ELSE error_code END AS error_code,
  CASE WHEN event_id % 25 = 7 THEN 'UNKNOWN'
       WHEN event_id % 10 = 3 THEN ' ' || lower(severity) ELSE severity END AS severity,
  resolved, resolution_time_min
FROM v_errors
""", ["v_errors"])

view("v_dirty_devices", """
SELECT device_id, station,
  CASE WHEN device_id % 3 = 0 THEN ' ' || lower(gate_type) || ' ' ELSE gate_type END AS gate_type,
  CASE WHEN device_id % 4 = 1 THEN lower(manufacturer) ELSE manufacturer END AS manufacturer,
  firmware_version, install_date,
  CASE WHEN device_id % 7 = 0 THEN 5000 ELSE age_days END AS age_days,
  warranty_remaining_days, failure_prone, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at
FROM v_devices
UNION ALL
SELECT device_id, upper(station),
  CASE WHEN device_id % 3 = 0 THEN ' ' || lower(gate_type) || ' ' ELSE gate_type END,
  CASE WHEN device_id % 4 = 1 THEN lower(manufacturer) ELSE manufacturer END,
  firmware_version, install_date,
  CASE WHEN device_id % 7 = 0 THEN 5000 ELSE age_days END,
  warranty_remaining_days, failure_prone, TIMESTAMP '2024-01-02 00:00:00'
FROM v_devices WHERE device_id % 5 = 0
""", ["v_devices"])

view("v_dirty_maintenance", """
SELECT device_id, date,
  CASE WHEN maintenance_id % 4 = 0 THEN ' ' || lower(maintenance_type) || ' ' ELSE maintenance_type END AS maintenance_type,
  issue_description, sla_target_hours,
  CASE WHEN maintenance_id % 10 = 0 THEN CAST(500 AS DOUBLE) ELSE actual_resolution_hours END AS actual_resolution_hours,
  sla_met,
  CASE WHEN maintenance_id % 9 = 0 THEN CAST(25000 AS DOUBLE) ELSE cost_gbp END AS cost_gbp,
  technician_id, parts_replaced, maintenance_id
FROM v_maintenance
""", ["v_maintenance"])


def _order(names):
    seen: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs for ``names`` (and their dependencies)."""
    ctes = [f"{n} AS ({VIEWS[n].strip()})" for n in _order(names)]
    for n, sql in extra or []:
        ctes.append(f"{n} AS ({sql.strip()})")
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
