"""Queries: drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstile.operators import drift as dr
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import materialize
from turnstile.sources.canonical import Fleet

CATEGORICAL = ["top_error_code", "manufacturer", "firmware_version", "gate_type"]


def _tagged(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("drift_tagged", lambda: dr.split_at_nth_date(
        f.gold().select("device_id", "date", *dr.MONITOR_FEATURES, *CATEGORICAL), 20))


def _ks(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    # one row per feature; several reports read it
    return f._m("drift_ks", lambda: materialize(dr.ks_drift(_tagged(spark, sf_dir)), "drift-ks"))


@register("d1_period_split")
def d1_period_split(spark, sf_dir):
    t = _tagged(spark, sf_dir)
    return t.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                                   F.max("date").alias("last_date"))


@register("d1_daily_split")
def d1_daily_split(spark, sf_dir):
    t = dr.split_at_share(Fleet(spark, sf_dir).gold().select("device_id", "date"), 0.7, 10)
    return t.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"))


@register("d2_ks_drift")
def d2_ks_drift(spark, sf_dir):
    return round_doubles(_ks(spark, sf_dir))


@register("d3_chi_square")
def d3_chi_square(spark, sf_dir):
    return round_doubles(dr.chi_square_drift(_tagged(spark, sf_dir), CATEGORICAL).select("feature", "chi2", "dof"))


@register("d3_chi_square_pvalue")
def d3_chi_square_pvalue(spark, sf_dir):
    return round_doubles(dr.chi_square_drift(_tagged(spark, sf_dir), CATEGORICAL))


@register("d4_drift_share")
def d4_drift_share(spark, sf_dir):
    return round_doubles(dr.drift_share(_ks(spark, sf_dir)))


@register("d5_retrain_decision")
def d5_retrain_decision(spark, sf_dir):
    return round_doubles(dr.retrain_decision(dr.drift_share(_ks(spark, sf_dir))))


@register("d6_data_summary")
def d6_data_summary(spark, sf_dir):
    return round_doubles(dr.data_summary(_tagged(spark, sf_dir), dr.MONITOR_FEATURES))


@register("d6_duplicates")
def d6_duplicates(spark, sf_dir):
    """Duplicate device-days per period of the telemetry as delivered."""
    t = dr.split_at_share(Fleet(spark, sf_dir).dirty_telemetry().select("device_id", "date"), 0.7, 10)
    return dr.duplicate_summary(t, ["device_id", "date"])


@register("d8_decision_grid")
def d8_decision_grid(spark, sf_dir):
    """The matrix over shares and AUCs spread over the devices, edges included."""
    d = Fleet(spark, sf_dir).devices().select(
        "device_id", (F.pmod("device_id", F.lit(7)) / 10).alias("drift_share"), (F.pmod("device_id", F.lit(16)) / 100 + 0.80).alias("auc"))
    return round_doubles(dr.decision_matrix(d.withColumn("auc", F.round("auc", 2))))


@register("d7_retrain_rule")
def d7_retrain_rule(spark, sf_dir):
    """The retrain rule for every day of the history, with the last retrain 20 days
    before the first day and the drift decision of the current split."""
    g = Fleet(spark, sf_dir).gold()
    dec = dr.retrain_decision(dr.drift_share(_ks(spark, sf_dir))).first()  # one decision row
    d0 = g.agg(F.min("date")).first()[0]  # one scalar
    state = g.select(F.col("date").alias("current_date")).distinct().select(
        "current_date",
        F.date_sub(F.lit(d0), 20).alias("last_retrain_date"),
        (F.dayofmonth("current_date") == 1).alias("force"),
        F.lit(bool(dec["should_retrain"])).alias("drift_retrain"),
        F.lit(float(dec["drift_share"])).alias("drift_share"))
    return dr.retrain_rule(state).select("current_date", "retrain", "reason")
