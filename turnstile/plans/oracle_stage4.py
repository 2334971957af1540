"""Oracle SQL: error patterns."""

from __future__ import annotations

from turnstile.plans.oracle import oracle
from turnstile.plans.oracle_views import with_views

BASKETS = """
SELECT device_id, CAST("timestamp" AS DATE) AS date, count(*) AS n_raw, count(DISTINCT error_code) AS n_items
FROM v_errors GROUP BY 1, 2 HAVING count(*) >= 2
"""
BI = """
SELECT DISTINCT e.device_id, CAST(e."timestamp" AS DATE) AS date, e.error_code AS code
FROM v_errors e JOIN baskets b ON e.device_id = b.device_id AND CAST(e."timestamp" AS DATE) = b.date
"""
FI = """
SELECT * FROM (
  SELECT code AS i1, NULL AS i2, NULL AS i3, 1 AS size, count(*) AS cnt FROM bi GROUP BY code
  UNION ALL
  SELECT a.code, b.code, NULL, 2, count(*) FROM bi a JOIN bi b
    ON a.device_id = b.device_id AND a.date = b.date AND a.code < b.code GROUP BY a.code, b.code
  UNION ALL
  SELECT a.code, b.code, c.code, 3, count(*) FROM bi a
    JOIN bi b ON a.device_id = b.device_id AND a.date = b.date AND a.code < b.code
    JOIN bi c ON a.device_id = c.device_id AND a.date = c.date AND b.code < c.code
  GROUP BY a.code, b.code, c.code) s,
  (SELECT count(*) AS n FROM baskets) t
WHERE n >= 10 AND cnt / n >= 0.05
"""
FI_KEYED = """
SELECT concat_ws(', ', i1, i2, i3) AS items, i1, i2, i3, size, cnt, cnt / n AS support FROM fi
"""
SPLITS = """
SELECT i1 AS ant, i2 AS con, support FROM fk WHERE size = 2
UNION ALL SELECT i2, i1, support FROM fk WHERE size = 2
UNION ALL SELECT i1, i2 || ', ' || i3, support FROM fk WHERE size = 3
UNION ALL SELECT i2, i1 || ', ' || i3, support FROM fk WHERE size = 3
UNION ALL SELECT i3, i1 || ', ' || i2, support FROM fk WHERE size = 3
UNION ALL SELECT i1 || ', ' || i2, i3, support FROM fk WHERE size = 3
UNION ALL SELECT i1 || ', ' || i3, i2, support FROM fk WHERE size = 3
UNION ALL SELECT i2 || ', ' || i3, i1, support FROM fk WHERE size = 3
"""
RULES = """
SELECT s.ant AS antecedents, s.con AS consequents, a.support AS antecedent_support,
  c.support AS consequent_support, s.support AS support, s.support / a.support AS confidence,
  s.support / a.support / c.support AS lift, s.support - a.support * c.support AS leverage,
  CASE WHEN s.support / a.support >= 1 THEN NULL ELSE (1 - c.support) / (1 - s.support / a.support) END AS conviction
FROM splits s JOIN fk a ON s.ant = a.items JOIN fk c ON s.con = c.items
WHERE s.support / a.support >= 0.3
"""
PAT_EXTRA = [("baskets", BASKETS), ("bi", BI), ("fi", FI), ("fk", FI_KEYED), ("splits", SPLITS), ("rules", RULES)]

oracle("a6_baskets", with_views("SELECT device_id, date, n_raw, n_items FROM baskets", "v_errors",
                                extra=[("baskets", BASKETS)]))
oracle("m11_itemsets", with_views("""
SELECT items, CAST(size AS INTEGER) AS size, cnt AS count, round(support, 6) AS support FROM fk""",
    "v_errors", extra=PAT_EXTRA[:4]))
oracle("m12_rules", with_views("""
SELECT antecedents, consequents, round(antecedent_support, 6) AS antecedent_support,
  round(consequent_support, 6) AS consequent_support, round(support, 6) AS support,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(leverage, 6) AS leverage,
  round(conviction, 6) AS conviction FROM rules""", "v_errors", extra=PAT_EXTRA))
oracle("m16_rule_metrics", with_views("""
SELECT count(*) AS rule_count, round(max(lift), 6) AS max_lift, round(avg(confidence), 6) AS mean_confidence
FROM rules""", "v_errors", extra=PAT_EXTRA))

TRANS = """
SELECT device_id, error_code AS from_error,
  lead(error_code) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id) AS to_error FROM v_errors
"""
TC = "SELECT from_error, to_error, count(*) AS count FROM trans WHERE to_error IS NOT NULL GROUP BY 1, 2"
oracle("w9_transitions", with_views("SELECT * FROM tc", "v_errors", extra=[("trans", TRANS), ("tc", TC)]))

CODES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]  # the event types of the driver data, upper-cased
_tot = " + ".join(f"coalesce(sum(count) FILTER (WHERE to_error = '{c}'), 0)" for c in CODES)
_cols = ", ".join(
    f"round(coalesce(sum(count) FILTER (WHERE to_error = '{c}'), 0) / "
    f"CASE WHEN ({_tot}) = 0 THEN 1 ELSE ({_tot}) END, 6) AS \"{c}\"" for c in CODES)
oracle("m13_transition_matrix", with_views(f"""
SELECT s.code AS from_error, {_cols}
FROM (SELECT DISTINCT error_code AS code FROM v_errors) s LEFT JOIN tc ON tc.from_error = s.code
GROUP BY s.code""", "v_errors", extra=[("trans", TRANS), ("tc", TC)]))
oracle("m14_significant_transitions", with_views("""
SELECT from_error, to_error, round(round(p, 4), 6) AS probability, count FROM (
  SELECT from_error, to_error, count, count / sum(count) OVER (PARTITION BY from_error) AS p FROM tc) x
WHERE p > 0.1""", "v_errors", extra=[("trans", TRANS), ("tc", TC)]))

ESC = """
SELECT * FROM (
  SELECT device_id, "timestamp", severity AS from_severity, error_code AS from_error,
    CASE severity WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 END AS r,
    lead(severity) OVER w AS to_severity, lead(error_code) OVER w AS to_error,
    lead(CASE severity WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 END) OVER w AS to_r
  FROM v_errors WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", event_id)) x
WHERE to_r > r
"""
oracle("w10_escalations", with_views(
    'SELECT device_id, "timestamp", from_severity, to_severity, from_error, to_error FROM esc',
    "v_errors", extra=[("esc", ESC)]))
oracle("a7_escalation_paths", with_views(
    "SELECT from_severity, to_severity, count(*) AS count FROM esc GROUP BY 1, 2", "v_errors", extra=[("esc", ESC)]))
oracle("a15_daily_escalations", with_views("""
SELECT count(*) FILTER (WHERE to_r > r) AS escalations FROM (
  SELECT r, lead(r) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id) AS to_r FROM (
    SELECT device_id, "timestamp", event_id,
      CASE severity WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'CRITICAL' THEN 3 ELSE 0 END AS r
    FROM v_errors WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15') a) b""", "v_errors"))
oracle("a14_daily_code_pairs", with_views("""
SELECT a.code AS code_a, b.code AS code_b, count(*) AS count
FROM dc a JOIN dc b ON a.device_id = b.device_id AND a.code < b.code
GROUP BY 1, 2 ORDER BY count DESC, code_a, code_b LIMIT 5""", "v_errors", extra=[("dc", """
SELECT DISTINCT device_id, error_code AS code FROM v_errors WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'""")]))

from turnstile.plans import oracle_stage5  # noqa: E402,F401
