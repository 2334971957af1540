"""Oracle SQL: anomalies/SPC, CDC, drift, streaming-as-batch."""

from __future__ import annotations

from turnstile.plans.oracle import oracle, with_gold  # noqa: F401
from turnstile.plans.oracle_views import with_views  # noqa: F401

SPC = ["signal_strength_dbm", "temperature_c", "response_time_ms", "error_count", "tap_success_rate", "health_score"]
DM = "\nUNION ALL\n".join(
    f"SELECT date, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS daily_mean FROM gold GROUP BY date" for c in SPC)
LIM = """
SELECT feature, avg(daily_mean) AS center_line, stddev_samp(daily_mean) AS sigma,
  avg(daily_mean) + 3 * stddev_samp(daily_mean) AS ucl, avg(daily_mean) - 3 * stddev_samp(daily_mean) AS lcl,
  avg(daily_mean) + 2 * stddev_samp(daily_mean) AS uwl, avg(daily_mean) - 2 * stddev_samp(daily_mean) AS lwl
FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY date) AS rn FROM dm) b WHERE rn <= 7
GROUP BY feature
"""
PTS = """
SELECT d.date, d.feature, d.daily_mean, l.center_line, l.ucl, l.lcl, l.uwl, l.lwl,
  d.daily_mean > l.ucl OR d.daily_mean < l.lcl AS violation,
  (d.daily_mean > l.uwl AND d.daily_mean <= l.ucl) OR (d.daily_mean < l.lwl AND d.daily_mean >= l.lcl) AS warning
FROM dm d JOIN lim l ON d.feature = l.feature
"""
SPC_EXTRA = [("dm", DM), ("lim", LIM), ("pts", PTS)]
oracle("a10_fleet_daily_means", with_gold(
    "SELECT date, feature, round(daily_mean, 6) AS daily_mean FROM dm", extra=SPC_EXTRA[:1]))
oracle("w12_spc_points", with_gold("""
SELECT date, feature, round(daily_mean, 6) AS daily_mean, round(center_line, 6) AS center_line,
  round(ucl, 6) AS ucl, round(lcl, 6) AS lcl, round(uwl, 6) AS uwl, round(lwl, 6) AS lwl, violation, warning
FROM pts""", extra=SPC_EXTRA))
oracle("w12_spc_summary", with_gold("""
SELECT feature, count(*) FILTER (WHERE violation) AS violations, count(*) FILTER (WHERE warning) AS warnings,
  round(round(any_value(center_line), 3), 6) AS center_line, round(round(any_value(ucl), 3), 6) AS ucl,
  round(round(any_value(lcl), 3), 6) AS lcl
FROM pts GROUP BY feature""", extra=SPC_EXTRA))
oracle("w13_western_electric", with_gold("""
SELECT date, feature, round(daily_mean, 6) AS daily_mean, round(mu, 6) AS mu, round(sd, 6) AS sd, beyond,
  sum(beyond) OVER (PARTITION BY feature ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 2 AS rule2_warning
FROM (SELECT *, CAST(coalesce(abs(daily_mean - mu) > 2 * sd, FALSE) AS INTEGER) AS beyond FROM (
  SELECT date, feature, daily_mean,
    avg(daily_mean) OVER (PARTITION BY feature ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mu,
    stddev_samp(daily_mean) OVER (PARTITION BY feature ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sd
  FROM dm) a) b""", extra=SPC_EXTRA[:1]))
_vals = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM gold" for c in SPC)
oracle("a21_outside_limits", with_gold("""
SELECT v.feature, count(*) FILTER (WHERE v.value > l.ucl OR v.value < l.lcl) AS outside
FROM vals v JOIN lim l ON v.feature = l.feature GROUP BY v.feature""", extra=SPC_EXTRA[:2] + [("vals", _vals)]))
ANOM = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms", "power_voltage",
        "memory_usage_pct", "cpu_usage_pct", "error_count", "tap_success_rate", "uptime_hours", "health_score"]
_z = ", ".join(
    f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}"
    for c in ANOM)
oracle("p15_zscore", with_gold(f"SELECT device_id, date, {_z} FROM gold"))

# ------------------------------------------------------------------ CDC
T_VALS = ["daily_taps", "tap_success_rate", "signal_strength_dbm", "temperature_c", "response_time_ms",
          "network_latency_ms", "power_voltage", "memory_usage_pct", "cpu_usage_pct", "error_count",
          "reboot_count", "uptime_hours", "failure_today"]
BATCH = """
SELECT * REPLACE (cpu_usage_pct + CASE WHEN device_id % 3 = 0 THEN 1 ELSE 0 END AS cpu_usage_pct)
FROM v_telemetry WHERE date = DATE '2024-01-15' AND device_id % 7 <> 0
UNION ALL
SELECT * REPLACE (DATE '2024-01-15' AS date) FROM v_telemetry
WHERE date = DATE '2024-01-14' AND device_id % 11 = 0
  AND device_id NOT IN (SELECT device_id FROM v_telemetry WHERE date = DATE '2024-01-15')
"""
_diff = " OR ".join(f"coalesce(CAST(n.{c} AS DOUBLE), 0) <> coalesce(CAST(o.{c} AS DOUBLE), 0)" for c in T_VALS)
CHANGES = f"""
SELECT coalesce(n.device_id, o.device_id) AS device_id, coalesce(n.date, o.date) AS date,
  CASE WHEN o.device_id IS NULL THEN 'INSERT' WHEN n.device_id IS NULL THEN 'DELETE'
       WHEN {_diff} THEN 'UPDATE' ELSE 'UNCHANGED' END AS change_type,
  CASE WHEN n.device_id IS NULL THEN o.cpu_usage_pct ELSE n.cpu_usage_pct END AS cpu_usage_pct,
  CASE WHEN n.device_id IS NULL THEN o.error_count ELSE n.error_count END AS error_count
FROM batch n FULL OUTER JOIN (SELECT * FROM v_telemetry WHERE date IN (SELECT date FROM batch)) o
  ON n.device_id = o.device_id AND n.date = o.date
"""
CDC_EXTRA = [("batch", BATCH), ("changes", CHANGES)]
oracle("c3_detect_changes", with_views(
    "SELECT device_id, date, change_type, round(cpu_usage_pct, 6) AS cpu_usage_pct FROM changes",
    "v_telemetry", extra=CDC_EXTRA))
oracle("c4_apply_changes", with_views("""
SELECT DISTINCT device_id, date, round(cpu_usage_pct, 6) AS cpu_usage_pct, error_count FROM (
  SELECT device_id, date, cpu_usage_pct, error_count FROM v_telemetry t
  WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.device_id = t.device_id AND c.date = t.date
                    AND c.change_type IN ('INSERT', 'UPDATE', 'DELETE'))
  UNION ALL
  SELECT device_id, date, cpu_usage_pct, error_count FROM changes WHERE change_type IN ('INSERT', 'UPDATE')) m""",
    "v_telemetry", extra=CDC_EXTRA))
oracle("c5_cdc_log", with_views("""
SELECT 'telemetry' AS table_name, DATE '2024-01-15' AS batch_date,
  count(*) FILTER (WHERE change_type = 'INSERT') AS inserts, count(*) FILTER (WHERE change_type = 'UPDATE') AS updates,
  count(*) FILTER (WHERE change_type = 'DELETE') AS deletes FROM changes""", "v_telemetry", extra=CDC_EXTRA))

_ROLL = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms",
         "error_count", "tap_success_rate", "memory_usage_pct", "cpu_usage_pct"]
_DELTA = ["signal_strength_dbm", "temperature_c", "error_count", "response_time_ms"]
_inc_cols = ([f"round({c}_7d_mean, 6) AS {c}_7d_mean" for c in _ROLL] + [f"round({c}_7d_std, 6) AS {c}_7d_std" for c in _ROLL]
             + [f"{c}_delta" if c == "error_count" else f"round({c}_delta, 6) AS {c}_delta" for c in _DELTA]
             + ["cumulative_errors", "cumulative_reboots", "failure_cumsum", "days_since_last_failure",
                "round(health_score, 6) AS health_score"])
oracle("c6_incremental_features", with_gold(
    f"SELECT device_id, date, {', '.join(_inc_cols)} FROM gold WHERE date >= DATE '2024-01-21'"))
oracle("c8_incremental_merge", with_views(
    "SELECT device_id, date, error_count, round(signal_strength_dbm, 6) AS signal_strength_dbm FROM v_telemetry",
    "v_telemetry"))
oracle("b11_device_watermarks", with_gold(
    "SELECT device_id, max(date) AS last_date, count(*) AS rows FROM gold GROUP BY device_id"))
oracle("b12_scd2_devices", with_views("""
SELECT device_id, station, firmware_version, gate_type, DATE '2024-01-01' AS valid_from,
  CASE WHEN device_id % 13 = 0 OR (device_id % 4 = 3 AND firmware_version <> 'v4.1.0') THEN DATE '2024-02-01' END AS valid_to,
  NOT (device_id % 13 = 0 OR (device_id % 4 = 3 AND firmware_version <> 'v4.1.0')) AS is_current
FROM v_devices
UNION ALL
SELECT device_id, station, 'v4.1.0', gate_type, DATE '2024-02-01', CAST(NULL AS DATE), TRUE
FROM v_devices WHERE device_id % 13 <> 0 AND device_id % 4 = 3 AND firmware_version <> 'v4.1.0'""", "v_devices"))

# ------------------------------------------------------------------ drift
MON = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms", "power_voltage",
       "memory_usage_pct", "cpu_usage_pct", "error_count", "tap_success_rate", "uptime_hours", "health_score",
       "daily_taps", "signal_strength_dbm_7d_mean", "error_count_7d_mean", "cumulative_errors"]
CATS = ["top_error_code", "manufacturer", "firmware_version", "gate_type"]
TAGGED = """
SELECT *, CASE WHEN date < (SELECT date FROM (SELECT DISTINCT date FROM gold) d ORDER BY date LIMIT 1 OFFSET 20)
  THEN 'reference' ELSE 'current' END AS period FROM gold
"""
LONG = "\nUNION ALL\n".join(
    f"SELECT period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM tagged WHERE {c} IS NOT NULL" for c in MON)
KS = """
SELECT feature, n_reference, n_current, ks_statistic, lam FROM (
  SELECT feature, max(n_ref_tot) AS n_reference, max(n_cur_tot) AS n_current, max(abs(f1 - f2)) AS ks_statistic,
    (sqrt(max(n_ref_tot) * max(n_cur_tot) / (max(n_ref_tot) + max(n_cur_tot))) + 0.12
     + 0.11 / sqrt(max(n_ref_tot) * max(n_cur_tot) / (max(n_ref_tot) + max(n_cur_tot)))) * max(abs(f1 - f2)) AS lam
  FROM (
    SELECT feature, sum(n_ref) OVER (PARTITION BY feature ORDER BY value) / sum(n_ref) OVER (PARTITION BY feature) AS f1,
      sum(n_cur) OVER (PARTITION BY feature ORDER BY value) / sum(n_cur) OVER (PARTITION BY feature) AS f2,
      sum(n_ref) OVER (PARTITION BY feature) AS n_ref_tot, sum(n_cur) OVER (PARTITION BY feature) AS n_cur_tot
    FROM (SELECT feature, value, count(*) FILTER (WHERE period = 'reference') AS n_ref,
                 count(*) FILTER (WHERE period = 'current') AS n_cur FROM long GROUP BY feature, value) c) x
  GROUP BY feature) y
"""
KSP = """
SELECT feature, CAST(n_reference AS BIGINT) AS n_reference, CAST(n_current AS BIGINT) AS n_current, ks_statistic,
  CASE WHEN lam < 0.001 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
    (SELECT sum(2 * power(-1, j - 1) * exp(-2 * j * j * lam * lam)) FROM range(1, 61) t(j)))) END AS p_value
FROM ks
"""
DRIFT_EXTRA = [("tagged", TAGGED), ("long", LONG), ("ks", KS), ("ksp", KSP)]
oracle("d1_period_split", with_gold(
    "SELECT period, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM tagged GROUP BY period",
    extra=DRIFT_EXTRA[:1]))
oracle("d1_daily_split", with_gold("""
SELECT CASE WHEN date < (SELECT date FROM (SELECT DISTINCT date FROM gold) d ORDER BY date
          LIMIT 1 OFFSET (SELECT CAST(floor(count(DISTINCT date) * 0.7) AS BIGINT) FROM gold))
       THEN 'reference' ELSE 'current' END AS period, count(*) AS rows, min(date) AS first_date
FROM gold GROUP BY 1"""))
oracle("d2_ks_drift", with_gold("""
SELECT feature, n_reference, n_current, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value,
  'ks' AS method, p_value < 0.05 AS drifted FROM ksp""", extra=DRIFT_EXTRA))
oracle("d4_drift_share", with_gold("""
SELECT count(*) AS n_features, count(*) FILTER (WHERE p_value < 0.05) AS n_drifted,
  round(avg(CAST(p_value < 0.05 AS DOUBLE)), 6) AS drift_share FROM ksp""", extra=DRIFT_EXTRA))
oracle("d5_retrain_decision", with_gold("""
SELECT round(s, 6) AS drift_share, 0.3::DOUBLE AS threshold, s > 0.3 AS should_retrain,
  'Drift share ' || printf('%.1f', s * 100) || '% ' || CASE WHEN s > 0.3 THEN 'exceeds' ELSE 'within' END
  || ' 30% threshold' AS reason
FROM (SELECT avg(CAST(p_value < 0.05 AS DOUBLE)) AS s FROM ksp) x""", extra=DRIFT_EXTRA))
_cl = "\nUNION ALL\n".join(f"SELECT period, '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM tagged" for c in CATS)
oracle("d3_chi_square", with_gold("""
SELECT feature, round(sum(CASE WHEN e_ref > 0 THEN (o_ref - e_ref) ^ 2 / e_ref ELSE 0 END
                        + CASE WHEN e_cur > 0 THEN (o_cur - e_cur) ^ 2 / e_cur ELSE 0 END), 6) AS chi2,
  CAST(count(*) - 1 AS INTEGER) AS dof
FROM (SELECT feature, o_ref, o_cur,
        (o_ref + o_cur) * sum(o_ref) OVER w / (sum(o_ref) OVER w + sum(o_cur) OVER w) AS e_ref,
        (o_ref + o_cur) * sum(o_cur) OVER w / (sum(o_ref) OVER w + sum(o_cur) OVER w) AS e_cur
      FROM (SELECT feature, category, count(*) FILTER (WHERE period = 'reference') AS o_ref,
                   count(*) FILTER (WHERE period = 'current') AS o_cur FROM cl GROUP BY feature, category) c
      WINDOW w AS (PARTITION BY feature)) x
GROUP BY feature""", extra=DRIFT_EXTRA[:1] + [("cl", _cl)]))
_ds = "\nUNION ALL\n".join(f"SELECT period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM tagged" for c in MON)
oracle("d6_data_summary", with_gold("""
SELECT period, feature, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS missing,
  count(DISTINCT value) AS "distinct", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
  round(max(value), 6) AS max
FROM ds GROUP BY period, feature""", extra=DRIFT_EXTRA[:1] + [("ds", _ds)]))

# ------------------------------------------------------------------ metrics on the rule baseline
BASE = "SELECT failure_next_3d AS y, 1.0::DOUBLE - health_score / 100 AS s FROM gold"
oracle("a17_class_balance", with_gold("""
SELECT failure_next_3d, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM gold GROUP BY failure_next_3d"""))
oracle("m6_confusion_matrix", with_gold(
    "SELECT y AS actual, CAST(s >= 0.5 AS INTEGER) AS predicted, count(*) AS count FROM bl GROUP BY 1, 2",
    extra=[("bl", BASE)]))
oracle("m5_baseline_metrics", with_gold("""
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
  round(auc, 6) AS roc_auc, round(ap, 6) AS average_precision, tp, fp, fn, tn
FROM (SELECT count(*) FILTER (WHERE y = 1 AND s >= 0.5) AS tp, count(*) FILTER (WHERE y <> 1 AND s >= 0.5) AS fp,
             count(*) FILTER (WHERE y = 1 AND s < 0.5) AS fn, count(*) FILTER (WHERE y <> 1 AND s < 0.5) AS tn
      FROM bl) c,
     (SELECT sum(pos * (coalesce(neg_below, 0) + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
        SELECT pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below
        FROM (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
              FROM bl GROUP BY s) g) a) r,
     (SELECT sum(pos * cp / (cp + cn)) / sum(pos) AS ap FROM (
        SELECT pos, sum(pos) OVER (ORDER BY s DESC) AS cp, sum(neg) OVER (ORDER BY s DESC) AS cn
        FROM (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
              FROM bl GROUP BY s) g) b) p""", extra=[("bl", BASE)]))
oracle("w16_roc_points", with_gold("""
SELECT round(s, 6) AS threshold, round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr,
  round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr
FROM (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM bl GROUP BY s) g
WINDOW w AS (ORDER BY s DESC)""", extra=[("bl", BASE)]))
_hl = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS treatment,
  round(round_even(avg(y) FILTER (WHERE x > m) * 10000, 0) / 10000, 6) AS failure_rate_high,
  round(round_even(avg(y) FILTER (WHERE x <= m) * 10000, 0) / 10000, 6) AS failure_rate_low,
  round(round_even((avg(y) FILTER (WHERE x > m) - avg(y) FILTER (WHERE x <= m)) * 10000, 0) / 10000, 6) AS difference,
  round(round_even(avg(y) FILTER (WHERE x > m) / greatest(avg(y) FILTER (WHERE x <= m), 0.001) * 100, 0) / 100, 6) AS risk_ratio
FROM (SELECT CAST(failure_next_3d AS DOUBLE) AS y, coalesce({c}, 0) AS x,
             median(coalesce({c}, 0)) OVER () AS m FROM gold) t""" for c in
    ["error_count", "temperature_c", "signal_strength_dbm", "memory_usage_pct", "age_days", "response_time_ms"])
oracle("a16_high_low_rates", with_gold(_hl))

# ------------------------------------------------------------------ streaming as batch, sources, sinks
TUMBLE = """
SELECT user_id AS device_id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'error') AS errors,
  round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS error_rate
FROM events GROUP BY 1, 2
"""
oracle("st3_tumbling_counts", with_views(TUMBLE))
oracle("st3_stream_tumbling", with_views(TUMBLE))
oracle("st1_ingest_stream", with_views(
    "SELECT CAST(ts AS DATE) AS date, count(*) AS events, count(DISTINCT user_id) AS devices FROM events GROUP BY 1"))
oracle("st2_cdc_stream", with_views(
    "SELECT device_id, date, error_count, round(cpu_usage_pct, 6) AS cpu_usage_pct FROM v_telemetry", "v_telemetry"))
oracle("st4_dedup_stream", with_views("SELECT event_type, count(*) AS events FROM events GROUP BY 1"))
oracle("st5_requests_per_minute", with_views("""
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) AS requests,
  count(*) FILTER (WHERE NOT success) AS failures,
  round(count(*) FILTER (WHERE NOT success) / count(*), 6) AS error_rate,
  round(avg(duration_ms), 6) AS avg_ms, round(max(duration_ms), 6) AS max_ms
FROM v_requests GROUP BY 1""", "v_requests"))
oracle("st5_hourly_latency", with_views("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests,
  round(avg(duration_ms), 6) AS avg_ms, round(max(duration_ms), 6) AS max_ms
FROM v_requests GROUP BY 1""", "v_requests"))
oracle("st5_requests_by_name", with_views("""
SELECT name, count(*) AS requests, round(avg(CAST(NOT success AS DOUBLE)), 6) AS error_rate
FROM v_requests GROUP BY 1""", "v_requests"))
oracle("st6_sliding_alerts", with_views("""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS requests,
  round(avg(CAST(NOT success AS DOUBLE)), 6) AS error_rate, 'error_rate' AS alerts
FROM (SELECT r.*, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS window_start
      FROM v_requests r, range(0, 5) t(k)) x
GROUP BY window_start HAVING avg(CAST(NOT success AS DOUBLE)) > 0.1""", "v_requests"))
oracle("st7_escalation_stream", with_views("""
SELECT device_id, "timestamp" AS ts, from_severity, to_severity, from_error, to_error FROM esc""",
    "v_errors", extra=[("esc", """
SELECT * FROM (
  SELECT device_id, "timestamp", severity AS from_severity, error_code AS from_error,
    CASE severity WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 END AS r,
    lead(severity) OVER w AS to_severity, lead(error_code) OVER w AS to_error,
    lead(CASE severity WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 END) OVER w AS to_r
  FROM v_errors WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", event_id)) x
WHERE to_r > r""")]))
_tcols = ["device_id", "date", "daily_taps", "tap_success_rate", "signal_strength_dbm", "temperature_c",
          "response_time_ms", "network_latency_ms", "power_voltage", "memory_usage_pct", "cpu_usage_pct",
          "error_count", "reboot_count", "uptime_hours", "failure_today"]
_tint = {"device_id", "date", "daily_taps", "error_count", "reboot_count", "failure_today"}
oracle("s1_csv_roundtrip", with_views(
    "SELECT " + ", ".join(c if c in _tint else f"round({c}, 6) AS {c}" for c in _tcols) + " FROM v_telemetry",
    "v_telemetry"))
oracle("s4_bronze_ingest", with_views(
    "SELECT date AS ingest_date, count(*) AS rows, count(DISTINCT device_id) AS devices FROM v_telemetry GROUP BY 1",
    "v_telemetry"))
oracle("s6_manifest", with_views("""
SELECT 'telemetry' AS table_name, count(*) AS rows FROM v_telemetry
UNION ALL SELECT 'error_logs', count(*) FROM v_errors""", "v_telemetry", "v_errors"))
oracle("b3_schema_evolution", with_views("""
SELECT CASE WHEN date < DATE '2024-01-15' THEN NULL WHEN device_id % 2 = 0 THEN 'stable' ELSE 'beta' END
  AS firmware_channel, count(*) AS rows, 'firmware_channel,part' AS added_columns
FROM v_telemetry GROUP BY 1""", "v_telemetry"))
from turnstile.plans import oracle_stage7  # noqa: E402,F401
