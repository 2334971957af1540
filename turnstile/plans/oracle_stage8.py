"""Oracle SQL for the inventory items given their own result."""

from __future__ import annotations

from turnstile.plans.oracle import ORACLE, oracle
from turnstile.plans.oracle_stage4 import PAT_EXTRA
from turnstile.plans.oracle_views import with_views

oracle("s2_multi_file_scan", with_views("SELECT date, count(*) AS rows FROM v_telemetry GROUP BY 1", "v_telemetry"))
oracle("s5_incremental_ingest", with_views("""
SELECT DATE '2024-01-15' AS ingest_date, count(*) AS rows, 1 AS batches
FROM v_errors WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'""", "v_errors"))
oracle("s8_parquet_roundtrip", with_views(
    "SELECT maintenance_id, device_id, date, round(cost_gbp, 6) AS cost_gbp FROM v_maintenance", "v_maintenance"))
oracle("p1_drop_meta", with_views("""
SELECT device_id, date, round(cpu_usage_pct, 6) AS cpu_usage_pct, round(signal_strength_dbm, 6) AS signal_strength_dbm
FROM v_dirty_telemetry_all""", "v_dirty_telemetry_all"))
oracle("p9_target_date", with_views("""
SELECT device_id, date, error_count, round(cpu_usage_pct, 6) AS cpu_usage_pct FROM v_telemetry
WHERE date = DATE '2024-01-15'""", "v_telemetry"))
oracle("p10_trailing_window", with_views("""
SELECT date, count(*) AS rows FROM v_telemetry
WHERE date >= DATE '2024-02-14' - INTERVAL 30 DAY GROUP BY 1""", "v_telemetry"))
oracle("p11_device_flags", with_views("""
SELECT device_id, CASE WHEN age_days > 1000 THEN 1 ELSE 0 END AS is_old_device,
  CASE WHEN firmware_version = 'v4.0.0-beta' THEN 1 ELSE 0 END AS is_beta_firmware,
  CASE WHEN warranty_remaining_days > 0 THEN 1 ELSE 0 END AS is_under_warranty,
  CASE WHEN station IN ('Kings Cross', 'Victoria', 'Waterloo', 'Oxford Circus', 'Bank', 'Canary Wharf',
    'Liverpool Street') THEN 1 ELSE 0 END AS is_high_traffic_station FROM v_devices""", "v_devices"))
oracle("p16_binarize_median", with_views("""
SELECT device_id, date, CAST(response_time_ms > (SELECT median(response_time_ms) FROM v_telemetry) AS INTEGER)
  AS slow_response FROM v_telemetry""", "v_telemetry"))
oracle("j6_key_matching", ORACLE["c5_cdc_log"].split("SELECT 'telemetry' AS table_name")[0] + """
SELECT change_type, count(*) AS rows FROM changes GROUP BY 1""")
oracle("u3_u4_key_sets", with_views("""
SELECT 'new_only' AS set, count(*) AS devices FROM kb WHERE device_id NOT IN (SELECT device_id FROM ka)
UNION ALL SELECT 'old_only', count(*) FROM ka WHERE device_id NOT IN (SELECT device_id FROM kb)
UNION ALL SELECT 'common', count(*) FROM kb WHERE device_id IN (SELECT device_id FROM ka)""", "v_telemetry",
    extra=[("ka", "SELECT device_id FROM v_telemetry WHERE date = DATE '2024-01-14'"),
           ("kb", "SELECT device_id FROM v_telemetry WHERE date = DATE '2024-01-15'")]))
oracle("u6_values_outside_set", with_views("""
SELECT DISTINCT gate_type AS extra_value FROM v_dirty_devices
WHERE gate_type NOT IN ('Entry', 'Exit', 'Wide_Entry', 'Wide_Exit')""", "v_dirty_devices"))
oracle("t4_top_rules_by_lift", with_views("""
SELECT antecedents, consequents, round(lift, 6) AS lift FROM rules
ORDER BY lift DESC, antecedents, consequents LIMIT 10""", "v_errors", extra=PAT_EXTRA))
oracle("m21_simplified_causal", ORACLE["a16_high_low_rates"])
oracle("c9_high_watermark_extract", with_views(
    "SELECT date, count(*) AS rows FROM v_telemetry WHERE date > DATE '2024-01-20' GROUP BY 1", "v_telemetry"))
oracle("b1_batch_metadata", with_views(
    "SELECT count(*) AS rows, 1 AS batches, 'run-1' AS run_id, 'csv' AS source FROM v_telemetry", "v_telemetry"))
