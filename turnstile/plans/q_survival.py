"""Queries: survival / SLA (M23-M32, W17-W18, A13) and scoring rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.operators import scoring as sc
from turnstile.operators import survival as sv
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.functions.exprs import np_round
from turnstile.session import materialize
from turnstile.sources.canonical import Fleet


def _surv(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("survival", lambda: sv.survival_dataset(f.gold()))


def _weibull(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    key = "weibull_fit"
    if key not in f._memo:
        f._memo[key] = sv.fit_weibull(_surv(spark, sf_dir))
    return f._memo[key]


@register("m23_survival_dataset")
def m23_survival_dataset(spark, sf_dir):
    return round_doubles(_surv(spark, sf_dir))


@register("w17_kaplan_meier")
def w17_kaplan_meier(spark, sf_dir):
    return round_doubles(sv.kaplan_meier(_surv(spark, sf_dir)))


@register("m27_km_by_group")
def m27_km_by_group(spark, sf_dir):
    return round_doubles(sv.kaplan_meier(_surv(spark, sf_dir), ["is_old_device"]))


@register("m24_weibull")
def m24_weibull(spark, sf_dir):
    p = _weibull(spark, sf_dir)
    return round_doubles(spark.createDataFrame(
        [(p["lambda_"], p["rho_"], p["events"], p["n"], p.get("interpretation"))],
        "lambda_ double, rho_ double, events int, n int, interpretation string"), 4)


def _stored_weibull(spark, sf_dir):
    """(lambda, rho) from the stored fit."""
    f = Fleet(spark, sf_dir)
    r = f._m("weibull_table", lambda: materialize(sv.weibull_params(_surv(spark, sf_dir)), "weibull")).first()
    return r["lambda_"], r["rho_"]


def _fitted_rul(spark, sf_dir):
    return sv.rul(_surv(spark, sf_dir), *_stored_weibull(spark, sf_dir))


@register("m25_weibull_curves_fitted")
def m25_weibull_curves_fitted(spark, sf_dir):
    last = _surv(spark, sf_dir).agg(F.max("duration_days")).first()[0] or 0  # one scalar
    return round_doubles(sv.weibull_curves(spark, *_stored_weibull(spark, sf_dir), max(90, last)))


@register("m26_reliability_fitted")
def m26_reliability_fitted(spark, sf_dir):
    return round_doubles(sv.reliability(_surv(spark, sf_dir).select("device_id"), *_stored_weibull(spark, sf_dir)))


@register("m32_sla_risk_fitted")
def m32_sla_risk_fitted(spark, sf_dir):
    return round_doubles(sv.sla_risk(_surv(spark, sf_dir), _fitted_rul(spark, sf_dir)).select(
        "device_id", "rul_median_days", "risk_tier", "sla_breach_prob", "sla_risk_score"))


@register("a13_rul_fleet_metrics_fitted")
def a13_rul_fleet_metrics_fitted(spark, sf_dir):
    return round_doubles(sv.rul_fleet_metrics(_fitted_rul(spark, sf_dir)))


@register("m30_risk_groups_fitted")
def m30_risk_groups_fitted(spark, sf_dir):
    """Groups by the fitted Cox model's partial hazard."""
    g = sv.risk_groups(sv.partial_hazard(_surv(spark, sf_dir), _cox(spark, sf_dir)["coef"]))
    return g.groupBy("risk_group").agg(F.count(F.lit(1)).alias("devices"), F.sum("event").alias("events"))


#: Fixed parameters for the queries that apply a fitted curve, so that SQL can follow them.
LAMBDA, RHO = 40.0, 1.3


@register("m25_weibull_curves")
def m25_weibull_curves(spark, sf_dir):
    last = _surv(spark, sf_dir).agg(F.max("duration_days")).first()[0] or 0  # one scalar
    return round_doubles(sv.weibull_curves(spark, LAMBDA, RHO, max(90, last)))


@register("m26_reliability")
def m26_reliability(spark, sf_dir):
    return round_doubles(sv.reliability(_surv(spark, sf_dir).select("device_id"), LAMBDA, RHO))


@register("m31_rul")
def m31_rul(spark, sf_dir):
    return round_doubles(sv.rul(_surv(spark, sf_dir), LAMBDA, RHO))


@register("m31_rul_fitted")
def m31_rul_fitted(spark, sf_dir):
    return round_doubles(_fitted_rul(spark, sf_dir))


@register("m32_sla_risk")
def m32_sla_risk(spark, sf_dir):
    s = _surv(spark, sf_dir)
    return round_doubles(sv.sla_risk(s, sv.rul(s, LAMBDA, RHO)).select(
        "device_id", "rul_median_days", "risk_tier", "sla_breach_prob", "sla_risk_score"))


@register("a13_rul_fleet_metrics")
def a13_rul_fleet_metrics(spark, sf_dir):
    return round_doubles(sv.rul_fleet_metrics(sv.rul(_surv(spark, sf_dir), LAMBDA, RHO)))


def _cox(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    if "cox_fit" not in f._memo:
        f._memo["cox_fit"] = sv.fit_cox(_surv(spark, sf_dir))
    return f._memo["cox_fit"]


@register("m28_cox")
def m28_cox(spark, sf_dir):
    return round_doubles(sv.cox_summary(_surv(spark, sf_dir), fit=_cox(spark, sf_dir)), 4)


def _rule_risk(spark, sf_dir):
    """A rule score as risk: whole points lost by the health score, so that many devices tie."""
    return _surv(spark, sf_dir).select("device_id", "duration_days", "event",
                                       F.floor(F.lit(100.0) - F.col("health_score")).cast("double").alias("partial_hazard"))


@register("m29_concordance")
def m29_concordance(spark, sf_dir):
    return round_doubles(sv.concordance_index(_rule_risk(spark, sf_dir)))


@register("m29_concordance_cox")
def m29_concordance_cox(spark, sf_dir):
    s = _surv(spark, sf_dir)
    fit = _cox(spark, sf_dir)
    return round_doubles(sv.concordance_index(sv.partial_hazard(s, fit["coef"])), 4)


@register("m30_risk_groups")
def m30_risk_groups(spark, sf_dir):
    g = sv.risk_groups(_rule_risk(spark, sf_dir))
    return g.groupBy("risk_group").agg(F.count(F.lit(1)).alias("devices"), F.sum("event").alias("events"))


# ------------------------------------------------------------------ scoring
def _latest(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("latest", lambda: sc.latest_per_device(f.gold()))


def _scored(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("scored", lambda: sc.root_cause(sc.error_indicators(sc.sla_rule_score(_latest(spark, sf_dir)))))


@register("p19_sla_rule_score")
def p19_sla_rule_score(spark, sf_dir):
    s = sc.sla_rule_score(_latest(spark, sf_dir))
    return round_doubles(s.select("device_id", "sla_risk_score", "rul_estimate_days", "risk_tier",
                                  "recommended_action", "sla_breach_probability"))


@register("p17_p18_tiers")
def p17_p18_tiers(spark, sf_dir):
    s = sc.tiers(sc.sla_rule_score(_latest(spark, sf_dir)), "sla_breach_probability")
    return round_doubles(s.select("device_id", "sla_breach_probability", "tier_batch", "tier_serving",
                                  "tier_confidence", "tier_action", "prediction"))


@register("p22_error_indicators")
def p22_error_indicators(spark, sf_dir):
    s = sc.error_indicators(_latest(spark, sf_dir))
    return round_doubles(s.select("device_id", "error_rate_per_day", "error_severity", "reboot_frequency",
                                  "likely_escalation"))


@register("p23_root_cause")
def p23_root_cause(spark, sf_dir):
    s = sc.root_cause(_latest(spark, sf_dir))
    return s.select("device_id", F.array_join(F.transform("risk_factors", lambda x: F.concat_ws(
        ":", x["factor"], x["impact"])), "; ").alias("risk_factors"), "total_risk_factors", "primary_cause")


@register("p20_default_features")
def p20_default_features(spark, sf_dir):
    req = _latest(spark, sf_dir).select("device_id", "signal_strength_dbm", "temperature_c", "error_count",
                                        "response_time_ms", "age_days")
    return round_doubles(sc.default_model_features(req))


@register("p21_validate_requests")
def p21_validate_requests(spark, sf_dir):
    req = _latest(spark, sf_dir).select("device_id", *[c for c in sc.REQUEST_BOUNDS if c in (
        "signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms", "power_voltage",
        "memory_usage_pct", "cpu_usage_pct", "error_count", "reboot_count", "uptime_hours", "daily_taps",
        "tap_success_rate", "health_score", "age_days", "cumulative_errors", "cumulative_reboots",
        "total_maintenance_count", "corrective_count", "emergency_count")])
    _, bad = sc.validate_requests(req)
    return bad.select("device_id", F.array_join("invalid_fields", ",").alias("invalid_fields"))


def _whole_fleet(spark, sf_dir):
    """Scored devices with a rule failure probability and tier, and the rule anomaly flag of their last day."""
    from turnstile.plans.q_anomaly import _rule_labeled

    f = Fleet(spark, sf_dir)

    def make():
        s = _scored(spark, sf_dir).withColumn("failure_probability", 1 - F.col("health_score") / 100)
        s = sc.tiers(s, "failure_probability").withColumnRenamed("tier_serving", "failure_risk_tier")
        lab = _rule_labeled(spark, sf_dir).select("device_id", "date", "anomaly_score", (F.col("anomaly_label") == 1).alias("is_anomaly"))
        return materialize(s.drop("anomaly_score").join(lab, ["device_id", "date"], "left"), "whole-fleet")

    return f._m("whole_fleet", make)


@register("a19_fleet_summary")
def a19_fleet_summary(spark, sf_dir):
    return round_doubles(sc.fleet_summary(_whole_fleet(spark, sf_dir)))


@register("a20_top_fleet_cause")
def a20_top_fleet_cause(spark, sf_dir):
    return sc.top_fleet_cause(_scored(spark, sf_dir))


@register("a22_rul_histogram")
def a22_rul_histogram(spark, sf_dir):
    return sc.rul_histogram(_scored(spark, sf_dir))


@register("a24_score_histogram")
def a24_score_histogram(spark, sf_dir):
    return sc.served_histograms(_whole_fleet(spark, sf_dir))


@register("a24_tier_counters")
def a24_tier_counters(spark, sf_dir):
    return sc.served_counters(_whole_fleet(spark, sf_dir), {"ps1": "failure_risk_tier", "ps5": "risk_tier"})


@register("a12_tier_counts")
def a12_tier_counts(spark, sf_dir):
    s = _scored(spark, sf_dir)
    n = F.sum("devices").over(Window.partitionBy())  # over the <= 4 tier rows
    c = s.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("devices"))
    return round_doubles(c.select("risk_tier", "devices", (F.col("devices") / n).alias("share")))


def _with_rul(spark, sf_dir):
    """The day's failure predictions, left-joined with the survival model's RUL and tier under names of their own."""
    rul = sv.rul(_surv(spark, sf_dir), LAMBDA, RHO).select("device_id", "rul_median_days", F.col("risk_tier").alias("rul_risk_tier"))
    preds = _whole_fleet(spark, sf_dir).select("device_id", "failure_probability", F.col("failure_risk_tier").alias("risk_tier"))
    return preds.join(rul, "device_id", "left")


@register("j5_predictions_with_rul")
def j5_predictions_with_rul(spark, sf_dir):
    return round_doubles(_with_rul(spark, sf_dir))


@register("a26_rul_tier_summary")
def a26_rul_tier_summary(spark, sf_dir):
    """Devices per RUL tier and mean RUL of the day's joined predictions."""
    return round_doubles(_with_rul(spark, sf_dir).agg(
        *[F.count_if(F.col("rul_risk_tier") == t).alias(f"{t.lower()}_devices") for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
        np_round(F.avg("rul_median_days"), 1).alias("mean_rul")))


@register("t4_dashboard_slices")
def t4_dashboard_slices(spark, sf_dir):
    """The first rows of the dashboard's sorted tables, each a TakeOrdered: (slice, rank, key, value)."""
    from turnstile.plans.catalog import QUERIES

    q = lambda name: QUERIES[name](spark, sf_dir)
    tables = [
        ("transitions", q("m14_significant_transitions"), F.concat_ws(">", "from_error", "to_error"), "probability", 10),
        ("anomalous_devices", q("a8_device_anomalies"), F.col("device_id").cast("string"), "anomaly_count", 10),
        ("sla_devices", q("m32_sla_risk"), F.col("device_id").cast("string"), "sla_risk_score", 10),
        ("causes", q("a16_high_low_rates"), F.col("treatment"), "risk_ratio", 15),
        ("rules", q("m12_rules"), F.concat_ws(">", "antecedents", "consequents"), "lift", 20),
    ]
    out = None
    for name, df, key, value, k in tables:
        best = df.select(key.alias("key"), F.col(value).cast("double").alias("value")).orderBy(F.col("value").desc(), "key").limit(k)
        rows = best.select(F.lit(name).alias("slice"), F.row_number().over(Window.orderBy(F.col("value").desc(), "key")).alias("rank"), "key", "value")
        out = rows if out is None else out.unionByName(rows)
    return round_doubles(out, 4)


def _dashboard(spark, sf_dir):
    """The values of the dashboard's blocks, written once for the table and the document."""
    from turnstile.plans.catalog import QUERIES

    def rows(name):
        return QUERIES[name](spark, sf_dir)

    def number(name, metric):
        return rows(name).agg(F.count(F.lit(1)).alias(metric))

    return Fleet(spark, sf_dir)._m("dashboard", lambda: materialize(sc.dashboard_values([
        ("ps1_failure_prediction", rows("m5_baseline_metrics"), None, ["roc_auc", "f1", "recall", "precision"]),
        ("ps2_error_patterns", number("m12_rules", "association_rules"), None, ["association_rules"]),
        ("ps2_error_patterns", number("m14_significant_transitions", "top_transitions"), None, ["top_transitions"]),
        ("ps2_error_patterns", number("w10_escalations", "severity_escalations"), None, ["severity_escalations"]),
        ("ps3_root_cause", rows("a20_top_fleet_cause"), "cause", ["affected_devices"]),
        ("ps4_anomaly_detection", rows("w12_spc_summary"), "feature", ["violations", "warnings"]),
        ("ps4_anomaly_detection", rows("a9_anomaly_feature_diff"), "feature", ["anomaly_mean", "normal_mean"]),
        ("ps5_sla_risk", rows("a13_rul_fleet_metrics"), None,
         ["mean_rul", "critical_devices", "high_devices", "medium_devices", "low_devices"]),
        ("drift_detection", rows("d4_drift_share"), None, ["n_features", "n_drifted", "drift_share"]),
        ("data_quality", rows("q10_summary"), "layer", ["total", "passed", "failed"]),
    ]), "dashboard"))


@register("a28_dashboard_summary")
def a28_dashboard_summary(spark, sf_dir):
    """Seven blocks; those of fitted models take the rule scores, so that SQL can follow every value."""
    return round_doubles(_dashboard(spark, sf_dir), 4)


@register("a28_dashboard_document")
def a28_dashboard_document(spark, sf_dir):
    """The same values as one JSON document, as a client of the dashboard gets them."""
    return sc.dashboard_document(_dashboard(spark, sf_dir))
