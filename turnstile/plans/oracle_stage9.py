"""Oracle SQL: rules behind fitted models on fixed parameters, whole summaries, watermarks, streams."""

from __future__ import annotations

from turnstile.plans.oracle import ORACLE, oracle, with_gold
from turnstile.plans.oracle_stage5 import LATEST, SC_EXTRA, SLA_S, SURV_EXTRA, _RULE_ORDER
from turnstile.plans.oracle_stage6 import CDC_EXTRA
from turnstile.plans.oracle_views import with_views

LAM, RHO = "40.0::DOUBLE", "1.3::DOUBLE"

# ------------------------------------------------------------------ Weibull rules
oracle("m25_weibull_curves", with_gold(f"""
SELECT CAST(t AS INTEGER) AS t, round(exp(-pow(t / {LAM}, {RHO})), 6) AS survival,
  round({RHO} / {LAM} * pow(t / {LAM}, {RHO} - 1), 6) AS hazard, round(pow(t / {LAM}, {RHO}), 6) AS cumulative_hazard
FROM (SELECT unnest(range(1, greatest(90, (SELECT max(duration_days) FROM surv)) + 1))::DOUBLE AS t) x""", extra=SURV_EXTRA))
oracle("m26_reliability", with_gold(
    "SELECT device_id, " + ", ".join(f"round(exp(-pow({d} / {LAM}, {RHO})), 6) AS reliability_{d}d" for d in (7, 14, 21, 30))
    + " FROM surv", extra=SURV_EXTRA))
# the definition itself: the first of 0..89 whose survival is under half of today's
RUL = f"""
SELECT device_id, duration_days, event, health_score, cumulative_errors, is_old_device, cur, rul_median_days,
  CASE WHEN rul_median_days <= 7 THEN 'CRITICAL' WHEN rul_median_days <= 14 THEN 'HIGH'
       WHEN rul_median_days <= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM (SELECT *, exp(-pow(duration_days / {LAM}, {RHO})) AS cur,
        CAST(coalesce((SELECT min(k) FROM range(0, 90) r(k)
          WHERE exp(-pow((duration_days + k) / {LAM}, {RHO})) < 0.5 * exp(-pow(duration_days / {LAM}, {RHO}))), 90) AS INTEGER) AS rul_median_days
      FROM surv) x
"""
RUL_EXTRA = SURV_EXTRA + [("rul", RUL)]
oracle("m31_rul", with_gold("""
SELECT device_id, duration_days AS current_age_days, rul_median_days, round(round_even(cur * 10000, 0) / 10000, 6) AS current_survival_prob,
  event AS event_observed, round(health_score, 6) AS health_score, risk_tier FROM rul""", extra=RUL_EXTRA))
oracle("m32_sla_risk", with_gold("""
SELECT device_id, rul_median_days, risk_tier, round(breach, 6) AS sla_breach_prob,
  round(round_even(least(100, greatest(0, (1 - health_score / 100) * 30 + breach * 40 + share * 20 + is_old_device * 10)) * 10, 0) / 10, 6)
    AS sla_risk_score
FROM (SELECT *, round_even(10000 / (1 + exp(0.1::DOUBLE * (rul_median_days - 15))), 0) / 10000 AS breach,
        coalesce(cumulative_errors / nullif((SELECT max(cumulative_errors) FROM rul), 0)::DOUBLE, 0) AS share FROM rul) x""", extra=RUL_EXTRA))
oracle("a13_rul_fleet_metrics", with_gold("""
SELECT round(avg(rul_median_days), 6) AS mean_rul, count(*) FILTER (WHERE risk_tier = 'CRITICAL') AS critical_devices,
  count(*) FILTER (WHERE risk_tier = 'HIGH') AS high_devices, count(*) FILTER (WHERE risk_tier = 'MEDIUM') AS medium_devices,
  count(*) FILTER (WHERE risk_tier = 'LOW') AS low_devices, count(*) FILTER (WHERE rul_median_days < 14) AS rul_lt_14
FROM rul""", extra=RUL_EXTRA))

# ------------------------------------------------------------------ concordance and risk groups on a rule score
RISK_EXTRA = SURV_EXTRA + [("risk", "SELECT device_id, duration_days AS t, event, floor(100 - health_score) AS r FROM surv")]
oracle("m29_concordance", with_gold("""
SELECT round(sum(CASE WHEN a.r > b.r THEN 1.0::DOUBLE WHEN a.r = b.r THEN 0.5 ELSE 0 END) / count(*), 6) AS concordance_index,
  count(*) AS comparable_pairs
FROM risk a JOIN risk b ON a.event = 1 AND b.t > a.t""", extra=RISK_EXTRA))
oracle("m30_risk_groups", with_gold("""
SELECT CASE WHEN r > (SELECT median(r) FROM risk) THEN 'High Risk' ELSE 'Low Risk' END AS risk_group, count(*) AS devices,
  CAST(sum(event) AS BIGINT) AS events FROM risk GROUP BY 1""", extra=RISK_EXTRA))

# ------------------------------------------------------------------ anomaly rules on a rule label
_AF = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms", "power_voltage", "memory_usage_pct",
       "cpu_usage_pct", "error_count", "tap_success_rate", "uptime_hours", "health_score"]
LABELED = ("SELECT *, CAST(health_score < thr AS INTEGER) AS anomaly_label FROM (SELECT device_id, date, "
           + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _AF) + ", (SELECT quantile_cont(coalesce(health_score, 0), 0.08) FROM gold) AS thr FROM gold) x")
LAB = [("labeled", LABELED)]
oracle("a25_anomaly_threshold", with_gold("""
SELECT count(*) AS rows, CAST(sum(anomaly_label) AS BIGINT) AS anomalies, round(max(thr), 6) AS threshold,
  round(avg(anomaly_label) * 100, 6) AS anomaly_rate_pct FROM labeled""", extra=LAB))
oracle("a8_device_anomalies", with_gold("""
SELECT device_id, CAST(sum(anomaly_label) AS BIGINT) AS anomaly_count, count(*) AS total_days,
  round(sum(anomaly_label) / count(*), 6) AS anomaly_rate FROM labeled GROUP BY device_id""", extra=LAB))
_SPC = ["signal_strength_dbm", "temperature_c", "response_time_ms", "error_count", "tap_success_rate", "health_score"]
oracle("a9_anomaly_feature_diff", with_gold("\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, round(a, 4) AS anomaly_mean, round(n, 4) AS normal_mean,
  round((a - n) / CASE WHEN n = 0 THEN 1 ELSE n END * 100, 4) AS pct_diff
FROM (SELECT avg({c}) FILTER (WHERE anomaly_label = 1) AS a, avg({c}) FILTER (WHERE anomaly_label = 0) AS n FROM labeled) x""" for c in _SPC), extra=LAB))
oracle("a10_daily_anomaly_rate", with_gold(
    "SELECT date, round(avg(anomaly_label) * 100, 6) AS anomaly_rate_pct FROM labeled GROUP BY date", extra=LAB))
oracle("p26_anomaly_feature_map", with_gold("\nUNION ALL\n".join(
    f"SELECT device_id, date, true AS is_anomaly, '{c}' AS feature, round(round_even({c}::DOUBLE * 100, 0) / 100, 6) AS value FROM labeled WHERE anomaly_label = 1"
    for c in _AF) + "\nUNION ALL SELECT device_id, date, false, NULL, NULL FROM labeled WHERE anomaly_label = 0", extra=LAB))

# ------------------------------------------------------------------ whole-fleet summaries
WHOLE = """
SELECT s.*, 1 - s.health_score / 100 AS failure_probability,
  CASE WHEN 1 - s.health_score / 100 >= 0.7 THEN 'CRITICAL' WHEN 1 - s.health_score / 100 >= 0.4 THEN 'HIGH'
       WHEN 1 - s.health_score / 100 >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS failure_risk_tier,
  l.anomaly_label = 1 AS is_anomaly, l.health_score - l.thr AS anomaly_score
FROM scored s LEFT JOIN labeled l ON s.device_id = l.device_id AND s.date = l.date
"""
WHOLE_EXTRA = SC_EXTRA + LAB + [("whole", WHOLE)]
_any = " OR ".join(f"({c})" for _, c in _RULE_ORDER)
oracle("a19_fleet_summary", with_gold(f"""
SELECT count(*) AS devices,
  {", ".join(f"count(*) FILTER (WHERE failure_risk_tier = '{t}') AS failure_{t.lower()}" for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))},
  count(*) FILTER (WHERE error_count >= 3) AS devices_errors_ge3, count(*) FILTER (WHERE error_count >= 5) AS devices_errors_ge5,
  round(round_even(avg(error_count) * 100, 0) / 100, 6) AS mean_error_count,
  count(*) FILTER (WHERE {_any}) AS devices_with_risk_factors,
  count(*) FILTER (WHERE is_anomaly) AS anomalies, count(*) FILTER (WHERE NOT is_anomaly) AS normal,
  {", ".join(f"count(*) FILTER (WHERE risk_tier = '{t}') AS tier_{t.lower()}" for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))},
  round(round_even(avg(rul_estimate_days) * 10, 0) / 10, 6) AS mean_rul
FROM whole""", extra=WHOLE_EXTRA))
_causes = " UNION ALL ".join(f"SELECT '{n}' AS cause FROM latest WHERE {c}" for n, c in _RULE_ORDER)
oracle("a20_top_fleet_cause", with_gold(f"""
SELECT coalesce(max(cause), 'None') AS cause, coalesce(max(n), 0) AS affected_devices
FROM (SELECT cause, count(*) AS n FROM ({_causes}) x GROUP BY cause ORDER BY n DESC, cause LIMIT 1) y""", extra=[("latest", LATEST)]))
_BOUNDS = {"failure_probability": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0], "anomaly_score": [-0.5, -0.3, -0.2, -0.1, 0, 0.1, 0.2, 0.3, 0.5],
           "sla_risk_score": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100], "rul_estimate_days": [7, 14, 21, 30, 45, 60, 90]}
oracle("a24_score_histogram", with_gold("\nUNION ALL\n".join(
    [f"SELECT '{c}' AS metric, '{b}' AS le, count(*) FILTER (WHERE {c} <= {b}::DOUBLE) AS count FROM whole" for c, bs in _BOUNDS.items() for b in bs]
    + [f"SELECT '{c}', '+Inf', count({c}) FROM whole" for c in _BOUNDS]), extra=WHOLE_EXTRA))
oracle("a24_tier_counters", with_gold("""
SELECT 'ps1' AS problem_statement, failure_risk_tier AS risk_tier, count(*) AS predictions FROM whole GROUP BY 2
UNION ALL SELECT 'ps5', risk_tier, count(*) FROM whole GROUP BY 2""", extra=WHOLE_EXTRA))


def _long(block, name, item, metrics):
    return [f"SELECT '{block}' AS block, {f'CAST({item} AS VARCHAR)' if item else chr(39) * 2} AS item, '{m}' AS metric, "
            f"round({m}::DOUBLE, 4) AS value FROM ({ORACLE[name]})" for m in metrics]


def dashboard(drift_values):
    parts = _long("ps1_failure_prediction", "m5_baseline_metrics", None, ["roc_auc", "f1", "recall", "precision"])
    for name, metric in (("m12_rules", "association_rules"), ("m14_significant_transitions", "top_transitions"), ("w10_escalations", "severity_escalations")):
        parts.append(f"SELECT 'ps2_error_patterns', '', '{metric}', count(*)::DOUBLE FROM ({ORACLE[name]})")
    parts += _long("ps3_root_cause", "a20_top_fleet_cause", "cause", ["affected_devices"])
    parts += _long("ps4_anomaly_detection", "w12_spc_summary", "feature", ["violations", "warnings"])
    parts += _long("ps4_anomaly_detection", "a9_anomaly_feature_diff", "feature", ["anomaly_mean", "normal_mean"])
    parts += _long("ps5_sla_risk", "a13_rul_fleet_metrics", None, ["mean_rul", "critical_devices", "high_devices", "medium_devices", "low_devices"])
    parts += _long("drift_detection", "d4_drift_share", None, drift_values)
    parts += _long("data_quality", "q10_summary", "layer", ["total", "passed", "failed"])
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ CDC (C2, C3 on dates, C5), label (B9), split counts (M1)
oracle("c2_watermark_decision", with_views("""
SELECT t AS table_name, d AS batch_date, (SELECT count(*) FROM batch) AS row_count, a AS action
FROM (VALUES ('telemetry', DATE '2024-01-15', 'skip'), ('telemetry', DATE '2024-01-15', 'reprocess'),
             ('telemetry', DATE '2024-01-16', 'process'), ('error_logs', DATE '2024-01-15', 'first_load')) v(t, d, a)""",
    "v_telemetry", extra=CDC_EXTRA))
oracle("c3_detect_changes_devices", with_views("""
SELECT device_id, CASE WHEN device_id % 13 = 0 THEN 'DELETE' WHEN device_id % 5 = 0 THEN 'UPDATE' ELSE 'UNCHANGED' END AS change_type,
  CASE WHEN device_id % 13 <> 0 AND device_id % 5 = 0 THEN install_date + 1 ELSE install_date END AS install_date
FROM v_devices""", "v_devices"))


def _day_counts(day, before):
    shift = f"DATE '{day}'"
    prev = f"DATE '{before}'"
    batch = f"""SELECT * REPLACE (cpu_usage_pct + CASE WHEN device_id % 3 = 0 THEN 1 ELSE 0 END AS cpu_usage_pct)
        FROM v_telemetry WHERE date = {shift} AND device_id % 7 <> 0
        UNION ALL SELECT * REPLACE ({shift} AS date) FROM v_telemetry WHERE date = {prev} AND device_id % 11 = 0
          AND device_id NOT IN (SELECT device_id FROM v_telemetry WHERE date = {shift})"""
    return f"""SELECT 'telemetry' AS table_name, {shift} AS batch_date,
        count(*) FILTER (WHERE o.device_id IS NULL) AS inserts,
        count(*) FILTER (WHERE n.device_id IS NOT NULL AND o.device_id IS NOT NULL AND n.cpu_usage_pct <> o.cpu_usage_pct) AS updates,
        count(*) FILTER (WHERE n.device_id IS NULL) AS deletes
      FROM ({batch}) n FULL OUTER JOIN (SELECT * FROM v_telemetry WHERE date = {shift}) o ON n.device_id = o.device_id"""


oracle("c5_cdc_log", with_views(_day_counts("2024-01-14", "2024-01-13") + " UNION ALL " + _day_counts("2024-01-15", "2024-01-14"), "v_telemetry"))
oracle("b9_failure_within_3d", with_views("""
SELECT a.device_id, a.date, CASE WHEN EXISTS (SELECT 1 FROM v_maintenance m WHERE m.device_id = a.device_id
    AND m.maintenance_type IN ('Corrective', 'Emergency')
    AND DATE '2024-01-01' + CAST(m.maintenance_id % 30 AS INTEGER) BETWEEN a.date + 1 AND a.date + 3) THEN 1 ELSE 0 END AS failure_within_3d
FROM v_telemetry a""", "v_telemetry", "v_maintenance"))
oracle("m1_stratified_split", with_gold("""
SELECT split, failure_next_3d, rows FROM (
  SELECT 'test' AS split, failure_next_3d, CAST(ceil(0.2 * count(*)) AS BIGINT) AS rows FROM gold GROUP BY failure_next_3d
  UNION ALL SELECT 'train', failure_next_3d, count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) FROM gold GROUP BY failure_next_3d) x"""))

# ------------------------------------------------------------------ streams over several batches and restarts (ST2)
oracle("st2_cdc_stream", with_views("""
SELECT device_id, date, CASE WHEN date = DATE '2024-01-15' THEN error_count + 1 ELSE error_count END AS error_count,
  round(cpu_usage_pct, 6) AS cpu_usage_pct
FROM v_telemetry WHERE date <> DATE '2024-01-15' OR device_id % 4 <> 0""", "v_telemetry"))
oracle("a28_dashboard_summary", dashboard(["n_features", "n_drifted", "drift_share"]))
oracle("a28_dashboard_document", f"""
SELECT '{{' || string_agg('"' || block || '":{{' || items || '}}', ',' ORDER BY block) || '}}' AS document
FROM (SELECT block, string_agg('"' || item || '":{{' || metrics || '}}', ',' ORDER BY item) AS items
      FROM (SELECT block, CASE WHEN item = '' THEN 'all' ELSE item END AS item,
                   string_agg('"' || metric || '":' || coalesce(CAST(CAST(round(value, 4) AS DECIMAL(20, 4)) AS VARCHAR), 'null'), ',' ORDER BY metric) AS metrics
            FROM ({ORACLE["a28_dashboard_summary"]}) v(block, item, metric, value) GROUP BY 1, 2) i GROUP BY block) b""")
# the chi-square tail as one less the series of the lower incomplete gamma function
oracle("d3_chi_square_pvalue", f"""
SELECT feature, chi2, dof, round(p_value, 6) AS p_value, 'chi_square' AS method, p_value < 0.05 AS drifted
FROM (SELECT feature, chi2, dof, CASE WHEN dof <= 0 THEN CAST('NaN' AS DOUBLE) WHEN chi2 <= 0 THEN 1.0 ELSE 1 - (
        SELECT sum(exp((dof / 2.0 + k) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + k + 1))) FROM range(0, 600) t(k)) END AS p_value
      FROM ({ORACLE["d3_chi_square"]}) c) x""")

# ------------------------------------------------------------------ patterns, top-k
oracle("t2_top_rules", "SELECT antecedents, consequents, confidence, lift FROM (" + ORACLE["m12_rules"]
       + ") ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 20")
oracle("t2_top_escalations", "SELECT * FROM (" + ORACLE["a7_escalation_paths"] + ") ORDER BY count DESC, from_severity, to_severity LIMIT 5")
oracle("t2_top_anomalous_devices", "SELECT * FROM (" + ORACLE["a8_device_anomalies"] + ") ORDER BY anomaly_count DESC, device_id LIMIT 5")
oracle("m16_rule_metrics", "SELECT *, (SELECT count(DISTINCT event_type) FROM events) AS states FROM (" + ORACLE["m16_rule_metrics"] + ")")

# ------------------------------------------------------------------ sources and sinks
oracle("s6_manifest", with_views("""
SELECT 'telemetry' AS table_name, count(DISTINCT date) AS files, count(*) AS rows FROM v_telemetry
UNION ALL SELECT 'error_logs', count(DISTINCT CAST("timestamp" AS DATE)), count(*) FROM v_errors""", "v_telemetry", "v_errors"))
oracle("s7_watermarked_ingest", with_views("""
SELECT 'telemetry' AS table_name, count(*) AS rows, 'first_load,process,skip,reprocess' AS actions FROM v_telemetry
WHERE date = DATE '2024-01-14' OR date = DATE '2024-01-15' AND device_id % 5 <> 0
UNION ALL SELECT 'error_logs', count(*), 'first_load,process,skip,reprocess' FROM v_errors
WHERE CAST("timestamp" AS DATE) = DATE '2024-01-14' OR CAST("timestamp" AS DATE) = DATE '2024-01-15' AND device_id % 5 <> 0""",
    "v_telemetry", "v_errors"))
_total = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c in _RULE_ORDER)
_primary = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in _RULE_ORDER) + " ELSE 'No significant risk factors' END"
oracle("s10_json_roundtrip", with_gold(
    f"SELECT device_id, CAST({_total} AS INTEGER) AS total_risk_factors, {_primary} AS primary_cause, CAST({_total} AS INTEGER) AS n_factors FROM latest",
    extra=[("latest", LATEST)]))
oracle("s11_export", with_gold("""
SELECT s AS feature_set, count(*) AS rows, n AS columns, count(DISTINCT device_id) AS devices
FROM gold, (VALUES ('ps1_failure_prediction', 39), ('ps4_anomaly_detection', 13), ('ps5_sla_risk', 16)) v(s, n) GROUP BY s, n"""))
oracle("s12_prediction_snapshot", with_gold("""
SELECT w.device_id, round(failure_probability, 6) AS failure_probability, failure_risk_tier, CAST(is_anomaly AS INTEGER) AS anomaly_label,
  round(anomaly_score, 6) AS anomaly_score, rul_median_days, w.risk_tier AS sla_risk_tier, round(sla_risk_score, 6) AS sla_risk_score
FROM whole w JOIN rul r ON w.device_id = r.device_id""", extra=WHOLE_EXTRA + RUL_EXTRA[1:]))
oracle("s13_serving_read", with_gold("""
SELECT device_id, date, round(coalesce(signal_strength_dbm_7d_std, 0), 6) AS signal_strength_dbm_7d_std,
  coalesce(error_count_delta, 0) AS error_count_delta, 0.0::DOUBLE AS ratio FROM gold"""))
oracle("b2_batch_manifest", with_views(
    "SELECT count(*) AS row_count, DATE '2024-01-14' AS watermark_before, max(date) AS watermark_after FROM batch",
    "v_telemetry", extra=CDC_EXTRA))

# ------------------------------------------------------------------ streams as batch
oracle("st5_anomalies_per_hour", with_views("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests, count(*) FILTER (WHERE duration_ms > 90) AS anomalies,
  round(count(*) FILTER (WHERE duration_ms > 90) / count(*), 6) AS anomaly_rate FROM v_requests GROUP BY 1""", "v_requests"))
_P = "list_sort(list(duration_ms))[CAST(greatest(1, ceil({q} * count(*))) AS BIGINT)]"
oracle("st5_latency_percentiles", with_views(f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, round({_P.format(q=0.5)}, 6) AS p50_ms, round({_P.format(q=0.95)}, 6) AS p95_ms,
  round({_P.format(q=0.99)}, 6) AS p99_ms FROM v_requests GROUP BY 1""", "v_requests"))
oracle("st5_sketched_percentiles", with_views("""
SELECT m AS minutes, time_bucket(to_minutes(m), ts, TIMESTAMP '2000-01-01') AS window_start, count(*) AS requests,
  true AS p50_within, true AS p95_within, true AS p99_within
FROM v_requests, (VALUES (5), (60), (1440)) t(m) GROUP BY 1, 2""", "v_requests"))
oracle("st6_latency_alerts", with_views(f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS requests, round({_P.format(q=0.99)}, 6) AS p99_ms,
  'p99_latency' AS alerts
FROM (SELECT r.*, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS window_start FROM v_requests r, range(0, 5) t(k)) x
GROUP BY window_start HAVING {_P.format(q=0.99)} > 60""", "v_requests"))
oracle("st6_metric_alerts", f"""
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'drift_share' AS metric, drift_share::DOUBLE AS value FROM ({ORACLE["d4_drift_share"]})
  UNION ALL SELECT 'quality_pass_rate', passed / total * 100 FROM ({ORACLE["q10_summary"]}) WHERE layer = 'overall'
  UNION ALL SELECT 'devices_at_risk', (critical_devices + high_devices)::DOUBLE FROM ({ORACLE["a13_rul_fleet_metrics"]})) v
WHERE metric = 'drift_share' AND value > 0.3 OR metric = 'quality_pass_rate' AND value < 90 OR metric = 'devices_at_risk' AND value > 20""")

# ------------------------------------------------------------------ retrain rules (D6-D8, C7), models by rule
_DRIFT = f"(SELECT should_retrain FROM ({ORACLE['d5_retrain_decision']}))"
_SHARE = f"(SELECT printf('%.1f', drift_share * 100) FROM ({ORACLE['d4_drift_share']}))"
oracle("d7_retrain_rule", f"""
SELECT current_date_ AS "current_date", forced OR days >= 15 OR drift AS retrain,
  CASE WHEN forced THEN 'Forced retraining' WHEN days >= 15 THEN 'Scheduled retrain (' || days || ' days since last)'
       WHEN drift THEN 'Drift detected (' || share || '% > 30%)' ELSE 'Not due (' || days || '/15 days, no drift)' END AS reason
FROM (SELECT d AS current_date_, day(d) = 1 AS forced, datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events) - 20, d) AS days,
        {_DRIFT} AS drift, {_SHARE} AS share FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) x) y""")
oracle("c7_training_log", f"""
SELECT run_date, reason, 3 AS models FROM (
  SELECT DATE '2024-01-01' AS run_date, 'First training (no previous record)' AS reason, true AS trains
  UNION ALL SELECT DATE '2024-01-08', 'Drift detected (' || {_SHARE} || '% > 30%)', {_DRIFT}
  UNION ALL SELECT DATE '2024-01-16', CASE WHEN {_DRIFT} THEN 'Drift detected (' || {_SHARE} || '% > 30%)'
    ELSE 'Scheduled retrain (15 days since last)' END, true) x WHERE trains""")
oracle("d8_decision_grid", with_views("""
SELECT device_id, round(s, 6) AS drift_share, round(a, 6) AS auc,
  CASE WHEN s > 0.5 THEN 'Emergency retrain + alert team'
       WHEN s > 0.3 THEN CASE WHEN a < 0.85 THEN 'Urgent retrain + root cause' ELSE 'Retrain (proactive)' END
       WHEN a < 0.85 THEN 'Investigate features, retrain' WHEN s >= 0.1 THEN 'Monitor, retrain next month'
       WHEN a > 0.9 THEN 'Do nothing' ELSE 'Monitor' END AS action
FROM (SELECT device_id, (device_id % 7)::DOUBLE / 10 AS s, round((device_id % 16)::DOUBLE / 100 + 0.8::DOUBLE, 2) AS a FROM v_devices) x""", "v_devices"))
oracle("m9_batch_summary", with_gold("""
SELECT count(*) AS devices, count(*) FILTER (WHERE p >= 0.4) AS high_risk_devices,
  count(*) FILTER (WHERE p > 0.7) AS tier_critical, count(*) FILTER (WHERE p > 0.4 AND p <= 0.7) AS tier_high,
  count(*) FILTER (WHERE p > 0.2 AND p <= 0.4) AS tier_medium, count(*) FILTER (WHERE p <= 0.2) AS tier_low
FROM (SELECT failure_probability AS p FROM whole) x""", extra=WHOLE_EXTRA))
oracle("m7_champion_rule", with_gold("""
SELECT model AS champion, roc_auc FROM (SELECT manufacturer AS model, round(avg(health_score) / 100, 3) AS roc_auc FROM gold GROUP BY 1) x
ORDER BY roc_auc DESC, model DESC LIMIT 1"""))
oracle("b14_rul_within_7d", with_gold(f"""
SELECT risk_tier, count(*) AS predictions, round(avg(CAST(abs(rul - days) <= 7 AS DOUBLE)), 6) AS within_7d
FROM (SELECT CASE WHEN s >= 70 THEN 'CRITICAL' WHEN s >= 50 THEN 'HIGH' WHEN s >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
        greatest(1, CAST(floor(90 * (1 - s / 100)) AS INTEGER)) AS rul, days
      FROM (SELECT g.*, {SLA_S} AS s, datediff('day', g.date,
              (SELECT min(h.date) FROM gold h WHERE h.device_id = g.device_id AND h.date > g.date AND h.failure_today = 1)) AS days FROM gold g) x
      WHERE days IS NOT NULL) y GROUP BY risk_tier"""))
_DELIVERED = """
SELECT device_id, date FROM v_telemetry
UNION ALL SELECT device_id, date FROM v_telemetry WHERE (device_id * 31 + day(date)) % 5 = 0
"""
oracle("d6_duplicates", with_views("""
SELECT period, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT CASE WHEN date < (SELECT date FROM (SELECT DISTINCT date FROM delivered) d ORDER BY date
          LIMIT 1 OFFSET (SELECT CAST(floor(count(DISTINCT date) * 0.7) AS BIGINT) FROM delivered))
        THEN 'reference' ELSE 'current' END AS period, device_id, date, count(*) AS n
      FROM delivered GROUP BY 1, 2, 3) x GROUP BY period""", "v_telemetry", extra=[("delivered", _DELIVERED)]))
oracle("a18_table_hash", with_views("""
SELECT count(*) AS row_count, true AS same_in_other_order, true AS sees_a_value, true AS sees_a_null, true AS sees_repeated_rows
FROM v_telemetry""", "v_telemetry"))
oracle("m33_annotated_anomalies", with_gold("""
SELECT device_id, date, round(health_score, 6) AS health_score, round(health_score - thr, 6) AS anomaly_score, anomaly_label FROM labeled""", extra=LAB))
# the chain run 400 steps from an even start
oracle("m15_stationary", "WITH RECURSIVE " + with_views("""
SELECT code AS error_code, round(p, 4) AS stationary_probability FROM chain WHERE k = 400""", "v_errors", extra=[
    ("tr", """SELECT error_code AS a, lead(error_code) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id) AS b FROM v_errors"""),
    ("tp", "SELECT a, b, count(*) / sum(count(*)) OVER (PARTITION BY a) AS p FROM tr WHERE b IS NOT NULL GROUP BY a, b"),
    ("chain", """SELECT 0 AS k, code, 1.0::DOUBLE / count(*) OVER () AS p FROM (SELECT DISTINCT error_code AS code FROM v_errors) c
       UNION ALL SELECT k + 1, b, sum(chain.p * tp.p)::DOUBLE FROM chain JOIN tp ON chain.code = tp.a WHERE k < 400 GROUP BY k, b"""),
])[len("WITH "):])

_J5 = """SELECT w.device_id, failure_probability, failure_risk_tier AS risk_tier, r.rul_median_days, r.risk_tier AS rul_risk_tier
FROM whole w LEFT JOIN rul r ON w.device_id = r.device_id"""
J5_EXTRA = WHOLE_EXTRA + RUL_EXTRA[1:] + [("joined", _J5)]
oracle("j5_predictions_with_rul", with_gold(
    "SELECT * REPLACE (round(failure_probability, 6) AS failure_probability) FROM joined", extra=J5_EXTRA))
oracle("a26_rul_tier_summary", with_gold("SELECT " + ", ".join(
    f"count(*) FILTER (WHERE rul_risk_tier = '{t}') AS {t.lower()}_devices" for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
    + ", round_even(avg(rul_median_days) * 10, 0) / 10 AS mean_rul FROM joined", extra=J5_EXTRA))


def _slice(name, query, key, value, k):
    return f"""SELECT '{name}' AS slice, CAST(row_number() OVER (ORDER BY value DESC, key) AS INTEGER) AS rank, key, round(value, 4) AS value
      FROM (SELECT {key} AS key, {value}::DOUBLE AS value FROM ({ORACLE[query]}) ORDER BY value DESC, key LIMIT {k})"""


oracle("t4_dashboard_slices", " UNION ALL ".join([
    _slice("transitions", "m14_significant_transitions", "from_error || '>' || to_error", "probability", 10),
    _slice("anomalous_devices", "a8_device_anomalies", "CAST(device_id AS VARCHAR)", "anomaly_count", 10),
    _slice("sla_devices", "m32_sla_risk", "CAST(device_id AS VARCHAR)", "sla_risk_score", 10),
    _slice("causes", "a16_high_low_rates", "treatment", "risk_ratio", 15),
    _slice("rules", "m12_rules", "antecedents || '>' || consequents", "lift", 20)]))
