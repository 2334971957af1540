"""Oracle SQL: survival dataset, Kaplan-Meier, scoring rules and fleet summaries."""

from __future__ import annotations

from turnstile.plans.oracle import oracle, with_gold

SURV = """
SELECT a.device_id,
  CAST(greatest(1, CASE WHEN ff IS NOT NULL THEN datediff('day', start, ff) + 1 ELSE n END) AS INTEGER) AS duration_days,
  CAST(ff IS NOT NULL AS INTEGER) AS event,
  coalesce(l.age_days, 0) AS age_days, coalesce(l.health_score, 50.0::DOUBLE) AS health_score,
  coalesce(l.error_count_7d_mean, 0.0::DOUBLE) AS error_count_7d_mean,
  coalesce(l.signal_strength_dbm_7d_mean, 80.0::DOUBLE) AS signal_strength_dbm_7d_mean,
  coalesce(l.temperature_c_7d_mean, 35.0::DOUBLE) AS temperature_c_7d_mean,
  coalesce(l.cumulative_errors, 0) AS cumulative_errors,
  coalesce(l.total_maintenance_count, 0) AS total_maintenance_count,
  coalesce(l.is_old_device, 0) AS is_old_device, coalesce(l.is_beta_firmware, 0) AS is_beta_firmware,
  coalesce(l.sla_compliance_rate, 1.0::DOUBLE) AS sla_compliance_rate
FROM (SELECT device_id, min(date) AS start, min(date) FILTER (WHERE failure_today = 1) AS ff, count(*) AS n
      FROM gold GROUP BY device_id) a
JOIN latest l ON a.device_id = l.device_id
"""
LATEST = """
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY date DESC) AS rk FROM gold) x
WHERE rk = 1
"""
SURV_EXTRA = [("latest", LATEST), ("surv", SURV)]
_sv_d = ["health_score", "error_count_7d_mean", "signal_strength_dbm_7d_mean", "temperature_c_7d_mean",
         "sla_compliance_rate"]
oracle("m23_survival_dataset", with_gold(
    "SELECT device_id, duration_days, event, age_days, cumulative_errors, total_maintenance_count, is_old_device, "
    "is_beta_firmware, " + ", ".join(f"round({c}, 6) AS {c}" for c in _sv_d) + " FROM surv", extra=SURV_EXTRA))


def _km(group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
SELECT {g}t AS timeline, at_risk, observed, censored,
  round(CASE WHEN max(CAST(observed = at_risk AS INTEGER)) OVER ({part}ORDER BY t ROWS UNBOUNDED PRECEDING) > 0
       THEN 0.0::DOUBLE
       ELSE exp(sum(CASE WHEN observed < at_risk THEN ln(1 - observed / at_risk) ELSE 0 END)
            OVER ({part}ORDER BY t ROWS UNBOUNDED PRECEDING)) END, 6) AS survival
FROM (SELECT {g}t, CAST(d_t AS BIGINT) AS observed, n_t - d_t AS censored,
        sum(n_t) OVER ({part.strip() or ''}) - coalesce(sum(n_t) OVER ({part}ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0) AS at_risk
      FROM (SELECT {g}duration_days AS t, count(*) AS n_t, CAST(sum(event) AS BIGINT) AS d_t FROM surv
            GROUP BY {g}duration_days) dt) x"""


oracle("w17_kaplan_meier", with_gold(_km(None), extra=SURV_EXTRA))
oracle("m27_km_by_group", with_gold(_km("is_old_device"), extra=SURV_EXTRA))

SLA_S = """least(100.0::DOUBLE, greatest(0.0::DOUBLE,
  (1 - coalesce(health_score, 50.0::DOUBLE) / 100) * 35 + least(coalesce(cumulative_errors, 0) / 50, 1) * 25
  + least(coalesce(age_days, 0) / 1500, 1) * 20 + least(coalesce(total_maintenance_count, 0) / 10, 1) * 10
  + CASE WHEN coalesce(emergency_count, 0) > 0 THEN 10 ELSE 0 END))"""
SCORED = f"""
SELECT *, round_even(s * 10, 0) / 10 AS sla_risk_score,
  CASE WHEN s >= 70 THEN 'CRITICAL' WHEN s >= 50 THEN 'HIGH' WHEN s >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  CASE WHEN s >= 70 THEN 'EMERGENCY: Schedule immediate replacement'
       WHEN s >= 50 THEN 'Schedule maintenance within 48 hours'
       WHEN s >= 30 THEN 'Plan preventive maintenance within 1 week' ELSE 'Continue standard monitoring' END
    AS recommended_action,
  round_even(10000 / (1 + exp(0.1 * (rul_estimate_days - 15))), 0) / 10000 AS sla_breach_probability
FROM (SELECT *, greatest(1, CAST(floor(90 * (1 - s / 100)) AS INTEGER)) AS rul_estimate_days
      FROM (SELECT *, {SLA_S} AS s FROM latest) a) b
"""
SC_EXTRA = [("latest", LATEST), ("scored", SCORED)]
oracle("p19_sla_rule_score", with_gold("""
SELECT device_id, round(sla_risk_score, 6) AS sla_risk_score, rul_estimate_days, risk_tier, recommended_action,
  round(sla_breach_probability, 6) AS sla_breach_probability FROM scored""", extra=SC_EXTRA))
oracle("p17_p18_tiers", with_gold("""
SELECT device_id, round(p, 6) AS sla_breach_probability,
  CASE WHEN p > -0.01 AND p <= 0.2 THEN 'LOW' WHEN p > 0.2 AND p <= 0.4 THEN 'MEDIUM'
       WHEN p > 0.4 AND p <= 0.7 THEN 'HIGH' WHEN p > 0.7 AND p <= 1.01 THEN 'CRITICAL' END AS tier_batch,
  CASE WHEN p >= 0.7 THEN 'CRITICAL' WHEN p >= 0.4 THEN 'HIGH' WHEN p >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS tier_serving,
  CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'HIGH' WHEN p >= 0.2 THEN 'MEDIUM' ELSE 'HIGH' END AS tier_confidence,
  CASE WHEN p >= 0.7 THEN 'EMERGENCY: Immediate replacement needed'
       WHEN p >= 0.4 THEN 'Schedule corrective maintenance within 48h'
       WHEN p >= 0.2 THEN 'Monitor closely, plan preventive maintenance' ELSE 'No immediate action needed' END AS tier_action,
  CAST(p >= 0.5 AS INTEGER) AS prediction
FROM (SELECT device_id, sla_breach_probability AS p FROM scored) x""", extra=SC_EXTRA))
oracle("p22_error_indicators", with_gold("""
SELECT device_id,
  round(round_even(cumulative_errors / greatest(age_days, 1) * 10000, 0) / 10000, 6) AS error_rate_per_day,
  CASE WHEN error_count >= 5 THEN 'HIGH' WHEN error_count >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS error_severity,
  round(round_even(cumulative_reboots / greatest(age_days, 1) * 30 * 100, 0) / 100, 6) AS reboot_frequency,
  error_count >= 3 AND emergency_count >= 1 AS likely_escalation
FROM latest""", extra=[("latest", LATEST)]))

_HIGH = [("Low signal strength", "signal_strength_dbm < 60"), ("High temperature", "temperature_c > 50"),
         ("High error count", "error_count >= 5"), ("Low tap success rate", "tap_success_rate < 0.85")]
_MED = [("High memory usage", "memory_usage_pct > 80"), ("High CPU usage", "cpu_usage_pct > 75"),
        ("Slow response time", "response_time_ms > 300"), ("Old device", "age_days > 1000"),
        ("Low uptime", "uptime_hours < 20")]
_RULE_ORDER = [_HIGH[0], _HIGH[1], _HIGH[2], _MED[0], _MED[1], _HIGH[3], _MED[2], _MED[3], _MED[4]]
_factors = ", ".join(f"CASE WHEN {c} THEN '{n}:HIGH' END" for n, c in _HIGH) + ", " + ", ".join(
    f"CASE WHEN {c} THEN '{n}:MEDIUM' END" for n, c in _MED)
_primary = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in _RULE_ORDER) + " ELSE 'No significant risk factors' END"
_total = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c in _RULE_ORDER)
oracle("p23_root_cause", with_gold(f"""
SELECT device_id, concat_ws('; ', {_factors}) AS risk_factors, CAST({_total} AS INTEGER) AS total_risk_factors,
  {_primary} AS primary_cause FROM latest""", extra=[("latest", LATEST)]))
oracle("p20_default_features", with_gold("""
SELECT device_id, round(signal_strength_dbm, 6) AS signal_strength_dbm, round(temperature_c, 6) AS temperature_c,
  error_count, round(response_time_ms, 6) AS response_time_ms, age_days,
  round(signal_strength_dbm, 6) AS signal_strength_dbm_7d_mean, round(temperature_c, 6) AS temperature_c_7d_mean,
  CAST(error_count AS DOUBLE) AS error_count_7d_mean, round(response_time_ms, 6) AS response_time_ms_7d_mean,
  3.0::DOUBLE AS signal_strength_dbm_7d_std, 1.0::DOUBLE AS error_count_7d_std,
  0.0::DOUBLE AS signal_strength_dbm_delta, 0.0::DOUBLE AS temperature_c_delta, 0.0::DOUBLE AS error_count_delta,
  10 AS days_since_last_failure, 0 AS manufacturer, 0 AS firmware_version, 0 AS gate_type,
  CAST(age_days > 1000 AS INTEGER) AS is_old_device, 0 AS is_beta_firmware,
  CAST(age_days < 730 AS INTEGER) AS is_under_warranty, 0 AS is_high_traffic_station
FROM latest""", extra=[("latest", LATEST)]))

_BOUNDS = [("signal_strength_dbm", 0, 100), ("temperature_c", -10, 80), ("response_time_ms", 10, None),
           ("network_latency_ms", 1, None), ("power_voltage", 2.0, 6.0), ("memory_usage_pct", 0, 100),
           ("cpu_usage_pct", 0, 100), ("error_count", 0, None), ("reboot_count", 0, None),
           ("uptime_hours", 0, 24), ("daily_taps", 0, None), ("tap_success_rate", 0, 1.0),
           ("health_score", 0, 100), ("age_days", 0, None), ("cumulative_errors", 0, None),
           ("cumulative_reboots", 0, None), ("total_maintenance_count", 0, None), ("corrective_count", 0, None),
           ("emergency_count", 0, None)]


def _bad(c, lo, hi):
    conds = [f"{c} < {lo}"] if lo is not None else []
    if hi is not None:
        conds.append(f"{c} > {hi}")
    return f"CASE WHEN {' OR '.join(conds)} THEN '{c}' END"


_badlist = ", ".join(_bad(*b) for b in _BOUNDS)
oracle("p21_validate_requests", with_gold(f"""
SELECT device_id, f AS invalid_fields FROM (SELECT device_id, concat_ws(',', {_badlist}) AS f FROM latest) x
WHERE f <> ''""", extra=[("latest", LATEST)]))

oracle("a19_fleet_summary", with_gold("""
SELECT count(*) AS devices,
  count(*) FILTER (WHERE risk_tier = 'CRITICAL') AS tier_critical, count(*) FILTER (WHERE risk_tier = 'HIGH') AS tier_high,
  count(*) FILTER (WHERE risk_tier = 'MEDIUM') AS tier_medium, count(*) FILTER (WHERE risk_tier = 'LOW') AS tier_low,
  count(*) FILTER (WHERE error_count >= 3) AS devices_errors_ge3,
  count(*) FILTER (WHERE error_count >= 5) AS devices_errors_ge5,
  round(avg(error_count), 6) AS mean_error_count, round(avg(rul_estimate_days), 6) AS mean_rul
FROM scored""", extra=SC_EXTRA))
oracle("a20_top_fleet_cause", with_gold(f"""
SELECT primary_cause, count(*) AS affected_devices FROM (SELECT {_primary} AS primary_cause FROM latest) x
WHERE primary_cause <> 'No significant risk factors'
GROUP BY 1 ORDER BY affected_devices DESC, primary_cause LIMIT 1""", extra=[("latest", LATEST)]))
oracle("a22_rul_histogram", with_gold("""
SELECT CASE WHEN rul_estimate_days <= 7 THEN '<=7' WHEN rul_estimate_days <= 14 THEN '8-14'
            WHEN rul_estimate_days <= 30 THEN '15-30' WHEN rul_estimate_days <= 60 THEN '31-60' ELSE '>60' END AS bucket,
  count(*) AS devices FROM scored GROUP BY 1""", extra=SC_EXTRA))
_le = "\nUNION ALL\n".join(
    f"SELECT '{b}' AS le, count(*) FILTER (WHERE sla_risk_score <= {b}) AS count, round(sum(sla_risk_score), 6) AS sum FROM scored"
    for b in (10, 20, 30, 50, 70, 90))
oracle("a24_score_histogram", with_gold(
    _le + "\nUNION ALL\nSELECT '+Inf', count(sla_risk_score), round(sum(sla_risk_score), 6) FROM scored", extra=SC_EXTRA))
oracle("a12_tier_counts", with_gold("""
SELECT risk_tier, count(*) AS devices, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM scored GROUP BY risk_tier""", extra=SC_EXTRA))

from turnstile.plans import oracle_stage6  # noqa: E402,F401
