"""Queries: failure models and root causes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from turnstile.functions.exprs import np_round
from turnstile.operators import causes as cz
from turnstile.operators import drift as dr
from turnstile.operators import failure as fm
from turnstile.operators import scoring as sc
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import materialize
from turnstile.sources.canonical import Fleet

MODELS = ["random_forest", "gradient_boosting", "boosting_categorical"]


def _data(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("ml_data", lambda: materialize(
        fm.stratified_split(fm.prepare(f.gold()), fm.TARGET, ["device_id", "date"]), "ml-split"))


def _training(spark, sf_dir, others=0):
    """The training rows with weights from them alone, kept: re-read by every fit.  ``others``: fits of one task that run beside."""
    d = _data(spark, sf_dir)
    return fm.sized(fm.class_weights(d.where(F.col("split") == "train"), fm.TARGET), others=others).persist()


def _fit(spark, sf_dir, name, rows=None):
    f = Fleet(spark, sf_dir)
    key = f"model_{name}"
    if key not in f._memo:
        tr = _training(spark, sf_dir) if rows is None else rows
        f._memo[key] = fm.train(tr, name)
        if rows is None:
            tr.unpersist()
    return f._memo[key]


def _metrics(spark, sf_dir, name, rows=None):
    f = Fleet(spark, sf_dir)
    key = f"metrics_{name}"
    if key not in f._memo:
        model, _ = _fit(spark, sf_dir, name, rows)
        test = _data(spark, sf_dir).where(F.col("split") == "test")
        scored = fm.predict(model, fm.sized(test, 100_000, 1_000))
        f._memo[key] = fm.classification_metrics(scored).withColumn("model", F.lit(name))
    return f._memo[key]


def _all_metrics(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    if any(f"model_{m}" not in f._memo for m in MODELS):
        rows = _training(spark, sf_dir, len(MODELS) - 1)  # the boosted models, unless they take Spark's tasks for every level
        rows.count()  # made once, then read by all three
        # side by side, the one with most steps before its first tree ahead
        with ThreadPoolExecutor(len(MODELS)) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(_metrics), spark, sf_dir, m, rows) for m in reversed(MODELS)]:
                done.result()
        rows.unpersist()
    out = None
    for m in MODELS:
        x = _metrics(spark, sf_dir, m)
        out = x if out is None else out.unionByName(x)
    return out


def _baseline_pred(spark, sf_dir):
    """A rule baseline scored over every gold row: score = 1 - health_score / 100."""
    g = Fleet(spark, sf_dir).gold()
    return g.select("device_id", "date", fm.TARGET, (F.lit(1.0) - F.col("health_score") / 100).alias("score"))


@register("m1_stratified_split")
def m1_stratified_split(spark, sf_dir):
    d = _data(spark, sf_dir)
    return d.groupBy("split", fm.TARGET).agg(F.count(F.lit(1)).alias("rows"))


@register("a17_class_balance")
def a17_class_balance(spark, sf_dir):
    return round_doubles(fm.class_balance(Fleet(spark, sf_dir).gold(), fm.TARGET))


@register("m5_baseline_metrics")
def m5_baseline_metrics(spark, sf_dir):
    return round_doubles(fm.classification_metrics(_baseline_pred(spark, sf_dir)))


@register("m6_confusion_matrix")
def m6_confusion_matrix(spark, sf_dir):
    return fm.confusion_matrix(_baseline_pred(spark, sf_dir))


@register("w16_roc_points")
def w16_roc_points(spark, sf_dir):
    return round_doubles(fm.roc_points(_baseline_pred(spark, sf_dir)))


@register("m2_random_forest")
def m2_random_forest(spark, sf_dir):
    return round_doubles(_metrics(spark, sf_dir, "random_forest"), 4)


@register("m3_gradient_boosting")
def m3_gradient_boosting(spark, sf_dir):
    return round_doubles(_metrics(spark, sf_dir, "gradient_boosting"), 4)


@register("m4_boosting_categorical")
def m4_boosting_categorical(spark, sf_dir):
    return round_doubles(_metrics(spark, sf_dir, "boosting_categorical"), 4)


@register("m7_champion")
def m7_champion(spark, sf_dir):
    return round_doubles(fm.select_champion(_all_metrics(spark, sf_dir)), 4)


def _champion(spark, sf_dir):
    c = fm.select_champion(_all_metrics(spark, sf_dir)).first()
    return c["champion"], c["roc_auc"]


@register("m8_feature_importance")
def m8_feature_importance(spark, sf_dir):
    name, _ = _champion(spark, sf_dir)
    model, inputs = _fit(spark, sf_dir, name)
    pairs = fm.feature_importance(model, inputs, 15)
    return round_doubles(spark.createDataFrame(pairs, "feature string, importance double"), 6)


def _latest_pred(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    name, _ = _champion(spark, sf_dir)
    model, _ = _fit(spark, sf_dir, name)
    latest = sc.latest_per_device(fm.prepare(f.gold()))
    return fm.predict(model, latest)


@register("m9_batch_scoring")
def m9_batch_scoring(spark, sf_dir):
    s = fm.batch_scores(_latest_pred(spark, sf_dir))
    return round_doubles(s.select("device_id", "date", np_round(F.col("score"), 4).alias("failure_probability"),
                                  "risk_tier", "high_risk"), 4)


@register("m9_batch_summary")
def m9_batch_summary(spark, sf_dir):
    """Summary of a batch scored by rule: devices, high-risk devices, devices per tier."""
    from turnstile.plans.q_survival import _whole_fleet

    s = _whole_fleet(spark, sf_dir).select(F.col("failure_probability").alias("score"))
    return fm.score_summary(fm.batch_scores(s))


@register("m7_champion_rule")
def m7_champion_rule(spark, sf_dir):
    """The selection on fixed metrics for each manufacturer's rule score: the best AUC, ties by name."""
    g = Fleet(spark, sf_dir).gold()
    m = g.groupBy(F.col("manufacturer").alias("model")).agg(F.round(F.avg("health_score") / 100, 3).alias("roc_auc"))
    return fm.select_champion(m)


@register("m10_combined_scoring")
def m10_combined_scoring(spark, sf_dir):
    """All five analyses for every device's latest row, in one DataFrame."""
    f = Fleet(spark, sf_dir)
    pred = fm.batch_scores(_latest_pred(spark, sf_dir)).select(
        "device_id", np_round(F.col("score"), 4).alias("failure_probability"), F.col("risk_tier").alias("failure_tier"))
    latest = sc.latest_per_device(f.gold())
    rules = sc.root_cause(sc.error_indicators(sc.sla_rule_score(latest))).select(
        "device_id", "error_rate_per_day", "error_severity", "likely_escalation", "total_risk_factors",
        "primary_cause", "sla_risk_score", F.col("risk_tier").alias("sla_tier"), "rul_estimate_days")
    from turnstile.plans.q_anomaly import _labeled

    lab = _labeled(spark, sf_dir)
    anom = sc.latest_per_device(lab.select("device_id", "date", "anomaly_score", "anomaly_label")).drop("date")
    return round_doubles(pred.join(rules, "device_id").join(anom, "device_id", "left"), 4)


@register("a16_high_low_rates")
def a16_high_low_rates(spark, sf_dir):
    d = fm.prepare(Fleet(spark, sf_dir).gold())
    return round_doubles(cz.high_low_rates(d, fm.TARGET))


@register("m20_propensity_ate")
def m20_propensity_ate(spark, sf_dir):
    d = fm.prepare(Fleet(spark, sf_dir).gold())
    return cz.causal_effects(d, fm.TARGET, fm.NUMERIC_FEATURES + fm.CATEGORICAL_FEATURES)


@register("d8_decision_matrix")
def d8_decision_matrix(spark, sf_dir):
    from turnstile.plans.q_drift import _ks
    share = dr.drift_share(_ks(spark, sf_dir)).first()["drift_share"]
    _, auc = _champion(spark, sf_dir)
    m = _all_metrics(spark, sf_dir).select("model", "roc_auc").withColumn("drift_share", F.lit(float(share)))
    return round_doubles(dr.decision_matrix(m, "drift_share", "roc_auc"), 4)


# ------------------------------------------------------------------ attribution
def _attr(spark, sf_dir):
    from turnstile.operators import attribution as at

    f = Fleet(spark, sf_dir)
    if "attr" not in f._memo:
        name, _ = _champion(spark, sf_dir)
        model, inputs = _fit(spark, sf_dir, name)
        d = _data(spark, sf_dir)
        f._memo["attr"] = (materialize(at.attributions(model, d, ["device_id", "date"], inputs), "attributions"), inputs)
    return f._memo["attr"]


@register("m17_global_attribution")
def m17_global_attribution(spark, sf_dir):
    from turnstile.operators import attribution as at

    a, inputs = _attr(spark, sf_dir)
    return round_doubles(at.global_importance(a, inputs))


@register("m18_local_attribution")
def m18_local_attribution(spark, sf_dir):
    from turnstile.operators import attribution as at

    a, inputs = _attr(spark, sf_dir)
    return round_doubles(at.local_explanation(a, inputs, 5))


@register("m19_dependence")
def m19_dependence(spark, sf_dir):
    from turnstile.operators import attribution as at

    a, inputs = _attr(spark, sf_dir)
    top = at.global_importance(a, inputs).orderBy(F.col("mean_abs_attribution").desc(), "feature").first()["feature"]
    return round_doubles(at.dependence(a, _data(spark, sf_dir), ["device_id", "date"], top, inputs))


@register("b15_attribution_drift")
def b15_attribution_drift(spark, sf_dir):
    from turnstile.operators import attribution as at

    a, inputs = _attr(spark, sf_dir)
    return round_doubles(at.attribution_drift(a, inputs))
