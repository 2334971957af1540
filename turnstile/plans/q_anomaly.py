"""Queries: anomalies and SPC."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from turnstile.operators import anomaly as an
from turnstile.operators import scoring as sc
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import materialize, scratch_path
from turnstile.sources.canonical import Fleet
from turnstile.sources.sinks import write_parquet


def _labeled(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("if_labeled", lambda: an.isolation_forest(f.gold()))


@register("m22_isolation_forest")
def m22_isolation_forest(spark, sf_dir):
    return round_doubles(_labeled(spark, sf_dir).select("device_id", "date", "anomaly_score", "anomaly_label"))


def _rule_labeled(spark, sf_dir):
    """Labels from a rule score (the health score), so that SQL can follow them: the lowest 8 %."""
    f = Fleet(spark, sf_dir)

    def make():
        g = f.gold().select("device_id", "date", *an.ANOMALY_FEATURES).fillna(0)
        return materialize(an.label_anomalies(g.withColumn("rule_score", F.col("health_score")), 0.08, "rule_score"), "rule-labels")

    return f._m("rule_labeled", make)


def _threshold_summary(lab):
    return lab.agg(F.count(F.lit(1)).alias("rows"), F.sum("anomaly_label").alias("anomalies"), F.max("anomaly_threshold").alias("threshold"),
                   (F.avg("anomaly_label") * 100).alias("anomaly_rate_pct"))


def _feature_map(lab):
    m = sc.anomaly_feature_map(lab.withColumn("is_anomaly", F.col("anomaly_label") == 1))
    return m.select("device_id", "date", "is_anomaly", F.explode_outer("anomalous_features").alias("feature", "value"))


@register("a25_anomaly_threshold")
def a25_anomaly_threshold(spark, sf_dir):
    return round_doubles(_threshold_summary(_rule_labeled(spark, sf_dir)))


@register("a8_device_anomalies")
def a8_device_anomalies(spark, sf_dir):
    return round_doubles(an.device_anomaly_summary(_rule_labeled(spark, sf_dir)))


@register("a9_anomaly_feature_diff")
def a9_anomaly_feature_diff(spark, sf_dir):
    return round_doubles(an.anomaly_feature_diff(_rule_labeled(spark, sf_dir)), 4)


@register("a10_daily_anomaly_rate")
def a10_daily_anomaly_rate(spark, sf_dir):
    return round_doubles(an.daily_anomaly_rate(_rule_labeled(spark, sf_dir)))


@register("p26_anomaly_feature_map")
def p26_anomaly_feature_map(spark, sf_dir):
    """The map itself, one row an entry (rows without a map: one row with a null feature)."""
    return round_doubles(_feature_map(_rule_labeled(spark, sf_dir)))


# ------------------------------------------------------------------ the same on the isolation forest's labels
def _stored_labels(spark, sf_dir):
    """The forest's scores and labels, written once a session."""
    f = Fleet(spark, sf_dir)
    return f._m("if_labeled_table", lambda: materialize(_labeled(spark, sf_dir), "forest-labels"))


@register("a25_anomaly_threshold_fitted")
def a25_anomaly_threshold_fitted(spark, sf_dir):
    return round_doubles(_threshold_summary(_stored_labels(spark, sf_dir)))


@register("a8_device_anomalies_fitted")
def a8_device_anomalies_fitted(spark, sf_dir):
    return round_doubles(an.device_anomaly_summary(_stored_labels(spark, sf_dir)))


@register("a9_anomaly_feature_diff_fitted")
def a9_anomaly_feature_diff_fitted(spark, sf_dir):
    return round_doubles(an.anomaly_feature_diff(_stored_labels(spark, sf_dir)), 4)


@register("a10_daily_anomaly_rate_fitted")
def a10_daily_anomaly_rate_fitted(spark, sf_dir):
    return round_doubles(an.daily_anomaly_rate(_stored_labels(spark, sf_dir)))


@register("p26_anomaly_feature_map_fitted")
def p26_anomaly_feature_map_fitted(spark, sf_dir):
    return round_doubles(_feature_map(_stored_labels(spark, sf_dir)))


@register("m33_annotated_anomalies_fitted")
def m33_annotated_anomalies_fitted(spark, sf_dir):
    """The forest's annotated rows written by day and read back."""
    path = scratch_path(spark, f"gold/anomalies-{uuid.uuid4().hex}")
    write_parquet(_stored_labels(spark, sf_dir), path, ["date"])
    return round_doubles(spark.read.parquet(path).select("device_id", "date", "health_score", "anomaly_score", "anomaly_label"))


@register("a10_fleet_daily_means")
def a10_fleet_daily_means(spark, sf_dir):
    return round_doubles(an.fleet_daily_means(Fleet(spark, sf_dir).gold()))


@register("w12_spc_points")
def w12_spc_points(spark, sf_dir):
    return round_doubles(an.spc_points(Fleet(spark, sf_dir).gold()))


@register("w12_spc_summary")
def w12_spc_summary(spark, sf_dir):
    return round_doubles(an.spc_summary(Fleet(spark, sf_dir).gold()))


@register("w13_western_electric")
def w13_western_electric(spark, sf_dir):
    return round_doubles(an.western_electric_rule2(Fleet(spark, sf_dir).gold()))


@register("a21_outside_limits")
def a21_outside_limits(spark, sf_dir):
    g = Fleet(spark, sf_dir).gold()
    return an.count_outside_limits(g, an.spc_limits(g))


@register("p15_zscore")
def p15_zscore(spark, sf_dir):
    g = Fleet(spark, sf_dir).gold().select("device_id", "date", *an.ANOMALY_FEATURES)
    return round_doubles(an.zscore(g, an.ANOMALY_FEATURES))
