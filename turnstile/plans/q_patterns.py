"""Queries: error patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstile.operators import patterns as pt
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import materialize
from turnstile.sources.canonical import Fleet

DAY = "2024-01-15"


def _itemsets(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    return f._m("itemsets", lambda: materialize(pt.frequent_itemsets(f.error_logs()), "itemsets"))


@register("a6_baskets")
def a6_baskets(spark, sf_dir):
    b = pt.baskets(Fleet(spark, sf_dir).error_logs())
    return b.select("device_id", "date", "n_raw", F.size("items").cast("bigint").alias("n_items"))


@register("m11_itemsets")
def m11_itemsets(spark, sf_dir):
    return round_doubles(_itemsets(spark, sf_dir).select(F.array_join("items", ", ").alias("items"), "size", "count", "support"))


@register("m12_rules")
def m12_rules(spark, sf_dir):
    return round_doubles(pt.association_rules(_itemsets(spark, sf_dir), 0.3))


@register("t2_top_rules")
def t2_top_rules(spark, sf_dir):
    """The 20 rules of the highest lift, ties by confidence and names."""
    r = m12_rules(spark, sf_dir)
    return r.orderBy(F.col("lift").desc(), F.col("confidence").desc(), "antecedents", "consequents").limit(20).select(
        "antecedents", "consequents", "confidence", "lift")


@register("m16_rule_metrics")
def m16_rule_metrics(spark, sf_dir):
    """Rule count, max lift, mean confidence and the number of states of the transition chain."""
    states = Fleet(spark, sf_dir).error_logs().select("error_code").distinct().count()  # one scalar
    return round_doubles(pt.rule_metrics(pt.association_rules(_itemsets(spark, sf_dir), 0.3)).withColumn("states", F.lit(states).cast("bigint")))


@register("w9_transitions")
def w9_transitions(spark, sf_dir):
    return pt.transition_counts(Fleet(spark, sf_dir).error_logs())


@register("m13_transition_matrix")
def m13_transition_matrix(spark, sf_dir):
    return round_doubles(pt.transition_matrix(Fleet(spark, sf_dir).error_logs()))


@register("m14_significant_transitions")
def m14_significant_transitions(spark, sf_dir):
    return round_doubles(pt.significant_transitions(Fleet(spark, sf_dir).error_logs()))


@register("m15_stationary")
def m15_stationary(spark, sf_dir):
    return round_doubles(pt.stationary_distribution(Fleet(spark, sf_dir).error_logs()), 4)


@register("w10_escalations")
def w10_escalations(spark, sf_dir):
    return pt.escalations(Fleet(spark, sf_dir).error_logs())


@register("a7_escalation_paths")
def a7_escalation_paths(spark, sf_dir):
    return pt.escalation_paths(Fleet(spark, sf_dir).error_logs())


@register("a15_daily_escalations")
def a15_daily_escalations(spark, sf_dir):
    return pt.daily_escalation_count(Fleet(spark, sf_dir).error_logs(), DAY)


@register("a14_daily_code_pairs")
def a14_daily_code_pairs(spark, sf_dir):
    return pt.daily_code_pairs(Fleet(spark, sf_dir).error_logs(), DAY, 5)


@register("t2_top_escalations")
def t2_top_escalations(spark, sf_dir):
    """The 5 most frequent escalation paths."""
    return pt.escalation_paths(Fleet(spark, sf_dir).error_logs()).orderBy(
        F.col("count").desc(), "from_severity", "to_severity").limit(5)
