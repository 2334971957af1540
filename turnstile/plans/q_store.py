"""Queries: quality suites and scores (Q1-Q13), profile (A11), feature sets (S11), B10, B13."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from turnstile.functions.exprs import TELEMETRY_RANGES
from turnstile.operators import clean, profiles, quality, store
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.plans.q_gold import gold
from turnstile.session import scratch_path
from turnstile.sources.canonical import Fleet


def _suites(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    bt, bd = f.dirty_telemetry(), f.dirty_devices()
    st, sd = f.silver_telemetry(), f.silver_devices()
    return quality.run_suites(bt, bd, st, sd, gold(spark, sf_dir))


@register("q9_suites")
def q9_suites(spark, sf_dir):
    return round_doubles(_suites(spark, sf_dir))


@register("q10_summary")
def q10_summary(spark, sf_dir):
    return round_doubles(quality.summarize(_suites(spark, sf_dir)))


@register("q11_quality_score")
def q11_quality_score(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    t = clean.drop_meta(f.dirty_telemetry())
    cons = F.col("failure_today") == F.when(F.col("error_count") >= 2, 1).otherwise(0)
    return round_doubles(quality.quality_score(t, ["device_id", "date"], TELEMETRY_RANGES, cons))


@register("s11_feature_set_ps5")
def s11_feature_set_ps5(spark, sf_dir):
    return round_doubles(store.feature_set(gold(spark, sf_dir), "ps5_sla_risk"))


@register("a11_profile_numeric")
def a11_profile_numeric(spark, sf_dir):
    return round_doubles(store.profile_numeric(gold(spark, sf_dir)))


@register("a11_profile_strings")
def a11_profile_strings(spark, sf_dir):
    p = store.profile_strings(gold(spark, sf_dir), 5)
    return p.select("column", "unique_values", F.posexplode("top_values").alias("pos", "tv")).select(
        "column", "unique_values", (F.col("pos") + 1).alias("rank"), F.col("tv.value").alias("value"),
        F.col("tv.count").alias("count"))


@register("a11_table_profile")
def a11_table_profile(spark, sf_dir):
    return store.table_profile(gold(spark, sf_dir))


@register("b10_feature_catalog")
def b10_feature_catalog(spark, sf_dir):
    g = gold(spark, sf_dir)
    cat = store.feature_catalog(g)
    prof = store.profile_numeric(g).select(F.col("column").alias("feature"), "null_pct", "mean")
    return round_doubles(cat.join(prof, "feature", "left").select(
        "feature", "dtype", "source", "window", "null_rule", F.size("feature_sets").alias("n_feature_sets"),
        "null_pct", "mean"))


@register("b13_source_profile")
def b13_source_profile(spark, sf_dir):
    t = clean.drop_meta(Fleet(spark, sf_dir).dirty_telemetry())
    return round_doubles(store.source_profile(t, ["device_id", "date"], "date"))


def _profile_states(spark, sf_dir):
    """States of the gold table's days, loaded in two batches of days."""
    f = Fleet(spark, sf_dir)

    def make():
        kept = profiles.ProfileStore(spark, scratch_path(spark, f"profiles/{uuid.uuid4().hex}"))
        g, middle = gold(spark, sf_dir), datetime.date(2024, 1, 16)
        kept.add(g.where(F.col("date") < middle), "date", "first")
        kept.add(g.where(F.col("date").isNull() | (F.col("date") >= middle)), "date", "second")
        return kept.states()

    return f._m("profile_states", make)


def _numeric(states):
    return states.where(~F.col("dtype").isin("string", "date", "timestamp", "boolean"))


@register("a11_profile_merged")
def a11_profile_merged(spark, sf_dir):
    """The table's profile from the stored states of its days."""
    p = profiles.profile_of(_numeric(_profile_states(spark, sf_dir)))
    return round_doubles(p.select("column", "dtype", "rows", "nulls", "infinite", "null_pct", "low", "high", "mean", "std"))


@register("a11_profile_weekly")
def a11_profile_weekly(spark, sf_dir):
    """A profile a week, from the same states."""
    week = F.date_trunc("week", "day").cast("date").alias("week")
    p = profiles.profile_of(_numeric(_profile_states(spark, sf_dir)), [week])
    return round_doubles(p.select("week", "column", "rows", "nulls", "low", "high", "mean", "std"))


@register("a11_profile_sketches")
def a11_profile_sketches(spark, sf_dir):
    """Distinct values and quantiles by merged sketches, all columns."""
    p = profiles.profile_of(_profile_states(spark, sf_dir))
    return round_doubles(p.select("column", "rows", "nulls", "distinct_estimate", "p50", "p95", "p99"))


@register("q9_gold_suite_merged")
def q9_gold_suite_merged(spark, sf_dir):
    """The gold suite from the stored states; no row of the table is read again."""
    return round_doubles(profiles.validate_states(_profile_states(spark, sf_dir), quality.gold_suite(), "gold", "device_features"))
