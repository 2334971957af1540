"""Oracle SQL: quality suites / scores, profile, feature sets, catalog, source profile."""

from __future__ import annotations

from turnstile.operators.store import FEATURE_SETS
from turnstile.plans.oracle import oracle, with_gold
from turnstile.plans.oracle_more import DEDUP_T, T_COLS, T_INT, CLIPPED, DEDUP_D, clip, sql_title

# the gold table's column types, as Spark reports them
GOLD_TYPES = {
    'device_id': 'bigint', 'date': 'date', 'daily_taps': 'int', 'tap_success_rate': 'double',
    'signal_strength_dbm': 'double', 'temperature_c': 'double', 'response_time_ms': 'double',
    'network_latency_ms': 'double', 'power_voltage': 'double', 'memory_usage_pct': 'double',
    'cpu_usage_pct': 'double', 'error_count': 'int', 'reboot_count': 'int', 'uptime_hours': 'double',
    'failure_today': 'int', 'error_low_count': 'int', 'error_medium_count': 'int', 'error_high_count': 'int',
    'error_critical_count': 'int', 'top_error_code': 'string', 'unique_error_types': 'int',
    'error_resolution_rate': 'double', 'total_maintenance_count': 'bigint', 'corrective_count': 'bigint',
    'emergency_count': 'bigint', 'avg_resolution_hours': 'double', 'sla_compliance_rate': 'double',
    'total_cost_gbp': 'double', 'parts_replaced_count': 'bigint', 'station': 'string', 'gate_type': 'string',
    'manufacturer': 'string', 'firmware_version': 'string', 'age_days': 'int', 'warranty_remaining_days': 'int',
    'failure_prone': 'int', 'is_old_device': 'int', 'is_beta_firmware': 'int', 'is_under_warranty': 'int',
    'is_high_traffic_station': 'int', 'signal_strength_dbm_7d_mean': 'double', 'signal_strength_dbm_7d_std': 'double',
    'temperature_c_7d_mean': 'double', 'temperature_c_7d_std': 'double', 'response_time_ms_7d_mean': 'double',
    'response_time_ms_7d_std': 'double', 'network_latency_ms_7d_mean': 'double',
    'network_latency_ms_7d_std': 'double', 'error_count_7d_mean': 'double', 'error_count_7d_std': 'double',
    'tap_success_rate_7d_mean': 'double', 'tap_success_rate_7d_std': 'double', 'memory_usage_pct_7d_mean': 'double',
    'memory_usage_pct_7d_std': 'double', 'cpu_usage_pct_7d_mean': 'double', 'cpu_usage_pct_7d_std': 'double',
    'signal_strength_dbm_delta': 'double', 'temperature_c_delta': 'double', 'error_count_delta': 'int',
    'response_time_ms_delta': 'double', 'cumulative_errors': 'bigint', 'cumulative_reboots': 'bigint',
    'failure_cumsum': 'bigint', 'days_since_last_failure': 'int', 'health_score': 'double',
    'failure_next_3d': 'int', 'failure_within_3d': 'int',
}
NUMERIC_TYPES = {"int", "bigint", "double"}
GOLD_NUMERIC = [c for c, t in GOLD_TYPES.items() if t in NUMERIC_TYPES]
GOLD_DOUBLE = [c for c, t in GOLD_TYPES.items() if t == "double"]
GOLD_STRING = [c for c, t in GOLD_TYPES.items() if t == "string"]

SILVER_T = "SELECT device_id, date, " + ", ".join(
    (f"CAST(coalesce({c}, m_{c}) AS INTEGER) AS {c}" if c in T_INT else f"coalesce({c}, m_{c}) AS {c}")
    for c in T_COLS) + " FROM clipped, meds"
MEDS = "SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in T_COLS) + " FROM clipped"
SILVER_D = f"""SELECT device_id, {sql_title('station')} AS station, {sql_title('gate_type')} AS gate_type,
  CAST({clip('age_days', 0, 3650)} AS INTEGER) AS age_days FROM dedup_d"""
BRONZE_T = "SELECT * FROM v_dirty_telemetry_all"
SUITE_EXTRA = [("dedup", DEDUP_T), ("clipped", CLIPPED), ("meds", MEDS), ("silver_t", SILVER_T),
               ("dedup_d", DEDUP_D), ("silver_d", SILVER_D), ("bronze_t", BRONZE_T)]

GATE = "('Entry', 'Exit', 'Wide_Entry', 'Wide_Exit')"


def _check(layer, table, src, i, desc, success, observed):
    desc = desc.replace("'", "''")
    return (f"SELECT '{layer}' AS layer, '{table}' AS \"table\", {i} AS check_id, '{desc}' AS expectation, "
            f"{success} AS success, round(CAST({observed} AS DOUBLE), 6) AS observed FROM {src}")


def _suite_rows():
    rows = []

    def exists(layer, table, src, i, c):
        rows.append(_check(layer, table, src, i, f"column_exists({c})", "count(*) >= 0", "count(*) * 0 + 1"))

    def nn(layer, table, src, i, c, mostly):
        nr = f"avg(CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
        rows.append(_check(layer, table, src, i, f"not_null({c}, {mostly})", f"(1 - {nr}) >= {mostly}", nr))

    def btw(layer, table, src, i, c, lo, hi):
        x = f"CAST({c} AS DOUBLE)"
        rows.append(_check(layer, table, src, i, f"between({c}, {lo}, {hi})",
                           f"coalesce(min({x}) >= {float(lo)} AND max({x}) <= {float(hi)}, FALSE)", f"max({x})"))

    def cnt(layer, table, src, i, lo, hi):
        rows.append(_check(layer, table, src, i, f"row_count_between({lo}, {hi})", f"count(*) BETWEEN {lo} AND {hi}", "count(*)"))

    def uniq(layer, table, src, i, c):
        rows.append(_check(layer, table, src, i, f"unique({c})", f"count(DISTINCT {c}) = count({c})", f"count(DISTINCT {c})"))

    def mean(layer, table, src, i, c, lo, hi):
        m = f"avg(CAST({c} AS DOUBLE))"
        rows.append(_check(layer, table, src, i, f"mean_between({c}, {lo}, {hi})",
                           f"coalesce({m} BETWEEN {lo} AND {hi}, FALSE)", m))

    exists("bronze", "telemetry", "bronze_t", 0, "device_id")
    exists("bronze", "telemetry", "bronze_t", 1, "date")
    exists("bronze", "telemetry", "bronze_t", 2, "signal_strength_dbm")
    nn("bronze", "telemetry", "bronze_t", 3, "device_id", 1.0)
    nn("bronze", "telemetry", "bronze_t", 4, "date", 1.0)
    cnt("bronze", "telemetry", "bronze_t", 5, 100, 100000)
    exists("bronze", "devices", "v_dirty_devices", 0, "device_id")
    uniq("bronze", "devices", "v_dirty_devices", 1, "device_id")
    cnt("bronze", "devices", "v_dirty_devices", 2, 50, 1000)
    nn("silver", "telemetry", "silver_t", 0, "device_id", 1.0)
    nn("silver", "telemetry", "silver_t", 1, "date", 1.0)
    nn("silver", "telemetry", "silver_t", 2, "signal_strength_dbm", 0.99)
    for i, (c, lo, hi) in enumerate([("tap_success_rate", 0, 1.0), ("signal_strength_dbm", 0, 100),
                                     ("temperature_c", -10, 80), ("cpu_usage_pct", 0, 100),
                                     ("memory_usage_pct", 0, 100), ("uptime_hours", 0, 24)]):
        btw("silver", "telemetry", "silver_t", 3 + i, c, lo, hi)
    uniq("silver", "devices", "silver_d", 0, "device_id")
    nn("silver", "devices", "silver_d", 1, "station", 1.0)
    btw("silver", "devices", "silver_d", 2, "age_days", 0, 3650)
    bad = f"count(*) FILTER (WHERE gate_type IS NOT NULL AND gate_type NOT IN {GATE})"
    rows.append(_check("silver", "devices", "silver_d", 3,
                       "in_set(gate_type, ('Entry', 'Exit', 'Wide_Entry', 'Wide_Exit'))", f"{bad} = 0", bad))
    cnt("gold", "device_features", "gold", 0, 1000, 100000)
    exists("gold", "device_features", "gold", 1, "failure_today")
    exists("gold", "device_features", "gold", 2, "failure_next_3d")
    exists("gold", "device_features", "gold", 3, "health_score")
    nn("gold", "device_features", "gold", 4, "device_id", 1.0)
    nn("gold", "device_features", "gold", 5, "health_score", 0.95)
    mean("gold", "device_features", "gold", 6, "failure_today", 0.02, 0.4)
    mean("gold", "device_features", "gold", 7, "failure_next_3d", 0.02, 0.5)
    btw("gold", "device_features", "gold", 8, "health_score", 0, 100)
    btw("gold", "device_features", "gold", 9, "tap_success_rate", 0, 1.0)
    inf = " OR ".join(f"isinf({c})" for c in GOLD_DOUBLE)
    rows.append(_check("gold", "device_features", "gold", 10, "no_infinity()",
                       f"count(*) FILTER (WHERE {inf}) = 0", f"count(*) FILTER (WHERE {inf})"))
    return "\nUNION ALL\n".join(rows)


SUITES = _suite_rows()
oracle("q9_suites", with_gold(SUITES, "v_dirty_telemetry_all", "v_dirty_devices", extra=SUITE_EXTRA))
oracle("q10_summary", with_gold("""
SELECT layer, count(*) AS total, count(*) FILTER (WHERE success) AS passed,
  count(*) FILTER (WHERE NOT success) AS failed,
  round(count(*) FILTER (WHERE success) / greatest(count(*), 1) * 100, 6) AS pass_rate
FROM suites GROUP BY layer
UNION ALL
SELECT 'overall', count(*), count(*) FILTER (WHERE success), count(*) FILTER (WHERE NOT success),
  round(count(*) FILTER (WHERE success) / greatest(count(*), 1) * 100, 6) FROM suites""",
    "v_dirty_telemetry_all", "v_dirty_devices", extra=SUITE_EXTRA + [("suites", SUITES)]))

_T_RANGES = {
    "tap_success_rate": (0.0, 1.0), "signal_strength_dbm": (0.0, 100.0), "temperature_c": (-10.0, 80.0),
    "response_time_ms": (10.0, 5000.0), "network_latency_ms": (1.0, 1000.0), "power_voltage": (2.0, 6.0),
    "memory_usage_pct": (0.0, 100.0), "cpu_usage_pct": (0.0, 100.0), "error_count": (0, 100),
    "reboot_count": (0, 50), "uptime_hours": (0.0, 24.0),
}
_ALLT = ["device_id", "date"] + T_COLS
_nonnull = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _ALLT)
_valid = " AND ".join(f"({c} IS NULL OR {c} BETWEEN {lo} AND {hi})" for c, (lo, hi) in _T_RANGES.items())
oracle("q11_quality_score", with_gold(f"""
SELECT rows, round(completeness, 6) AS completeness, round(validity, 6) AS validity,
  round(consistency, 6) AS consistency, round(uniqueness, 6) AS uniqueness,
  round(0.4 * completeness + 0.3 * validity + 0.2 * consistency + 0.1 * uniqueness, 6) AS quality_score,
  (0.4 * completeness + 0.3 * validity + 0.2 * consistency + 0.1 * uniqueness) >= 0.97 AS gate_passed
FROM (SELECT count(*) AS rows,
    sum({_nonnull}) / (count(*) * {len(_ALLT)}) AS completeness,
    avg(CAST(({_valid}) AS DOUBLE)) AS validity,
    avg(CAST(coalesce(failure_today = CASE WHEN error_count >= 2 THEN 1 ELSE 0 END, FALSE) AS DOUBLE)) AS consistency,
    (SELECT count(*) FROM (SELECT DISTINCT device_id, date FROM bronze_t)) / count(*) AS uniqueness
  FROM bronze_t) s""", "v_dirty_telemetry_all", extra=SUITE_EXTRA))

PS5 = ["device_id", "date", "age_days", "total_maintenance_count", "corrective_count", "emergency_count",
       "avg_resolution_hours", "sla_compliance_rate", "total_cost_gbp", "health_score", "cumulative_errors",
       "cumulative_reboots", "error_count_7d_mean", "manufacturer", "firmware_version", "is_old_device"]
oracle("s11_feature_set_ps5", with_gold(
    "SELECT " + ", ".join(f"round({c}, 6) AS {c}" if GOLD_TYPES[c] == "double" else c for c in PS5) + " FROM gold"))

_prof = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{GOLD_TYPES[c]}' AS dtype, round(min(CAST({c} AS DOUBLE)), 6) AS min, "
    f"round(max(CAST({c} AS DOUBLE)), 6) AS max, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(avg(CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS null_pct FROM gold"
    for c in GOLD_NUMERIC)
oracle("a11_profile_numeric", with_gold(_prof))


def _merged(keys, group, more=""):
    """The profile of each numeric column in one pass over the rows."""
    return "\nUNION ALL\n".join(
        f"SELECT {keys}'{c}' AS \"column\", {more.replace('@', c).replace('#', GOLD_TYPES[c])}count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"round(min(CAST({c} AS DOUBLE)), 6) AS low, round(max(CAST({c} AS DOUBLE)), 6) AS high, "
        f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std FROM gold {group}"
        for c in GOLD_NUMERIC)


oracle("a11_profile_merged", with_gold(_merged("", "", "'#' AS dtype, count(*) FILTER (WHERE isinf(CAST(@ AS DOUBLE))) AS infinite, "
                                               "round((count(*) - count(@)) / count(*), 6) AS null_pct, ")))
oracle("a11_profile_weekly", with_gold(_merged("CAST(date_trunc('week', date) AS DATE) AS week, ", "GROUP BY 1")))
oracle("q9_gold_suite_merged", with_gold("SELECT * FROM suites WHERE layer = 'gold'", "v_dirty_telemetry_all", "v_dirty_devices",
                                         extra=SUITE_EXTRA + [("suites", SUITES)]))
_long = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, {c} AS value FROM gold WHERE {c} IS NOT NULL" for c in GOLD_STRING)
oracle("a11_profile_strings", with_gold("""
SELECT col AS "column", unique_values, CAST(rk AS INTEGER) AS rank, value, count FROM (
  SELECT col, value, count, count(*) OVER (PARTITION BY col) AS unique_values,
         row_number() OVER (PARTITION BY col ORDER BY count DESC, value) AS rk
  FROM (SELECT col, value, count(*) AS count FROM long GROUP BY col, value) v) r
WHERE rk <= 5""", extra=[("long", _long)]))
oracle("a11_table_profile", with_gold(f"""
SELECT count(*) AS total_records, {len(GOLD_TYPES)} AS total_features, min(date) AS date_start,
  max(date) AS date_end, count(DISTINCT device_id) AS devices FROM gold"""))
oracle("b13_source_profile", with_gold(f"""
SELECT count(*) AS rows,
  round(sum({" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _ALLT)}) / (count(*) * {len(_ALLT)}), 6) AS null_rate,
  round(1 - (SELECT count(*) FROM (SELECT DISTINCT device_id, date FROM bronze_t)) / count(*), 6) AS duplicate_rate,
  min(date) AS date_start, max(date) AS date_end
FROM bronze_t""", "v_dirty_telemetry_all", extra=SUITE_EXTRA))
_catalog = ", ".join(f"('{c}', '{t}', {sum(c in s.get('numeric', []) + s.get('categorical', []) + [s.get('target')] for s in FEATURE_SETS.values())})"
                     for c, t in GOLD_TYPES.items())
oracle("b10_feature_catalog", with_gold(f"""
SELECT feature, dtype, source, kind AS "window",
  CASE WHEN feature = 'top_error_code' THEN 'NONE' WHEN source IN ('error_logs', 'maintenance') THEN 'zero' ELSE 'median' END AS null_rule,
  CAST(n AS INTEGER) AS n_feature_sets, null_pct, mean
FROM (SELECT feature, dtype, n,
        CASE kind WHEN 'device-day' THEN 'error_logs' WHEN 'all history' THEN 'maintenance' WHEN 'static' THEN 'devices' ELSE 'telemetry' END AS source, kind
      FROM (SELECT feature, dtype, n, CASE
              WHEN contains(feature, '_7d_') THEN '7 rows'
              WHEN ends_with(feature, '_delta') THEN '1 row lag'
              WHEN starts_with(feature, 'cumulative_') OR feature IN ('failure_cumsum', 'days_since_last_failure') THEN 'running'
              WHEN (starts_with(feature, 'error_') AND feature <> 'error_count') OR feature IN ('top_error_code', 'unique_error_types') THEN 'device-day'
              WHEN feature IN ('total_maintenance_count', 'corrective_count', 'emergency_count', 'avg_resolution_hours', 'sla_compliance_rate',
                               'total_cost_gbp', 'parts_replaced_count') THEN 'all history'
              WHEN starts_with(feature, 'is_') OR feature IN ('station', 'gate_type', 'manufacturer', 'firmware_version', 'age_days',
                               'warranty_remaining_days', 'failure_prone') THEN 'static'
              ELSE 'day' END AS kind FROM (VALUES {_catalog}) v(feature, dtype, n)) k) c
LEFT JOIN (SELECT "column" AS feature, null_pct, mean FROM prof) p USING (feature)""", extra=[("prof", _prof)]))

from turnstile.plans import oracle_stage4  # noqa: E402,F401
