"""Queries for the silver layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstile.functions.exprs import TELEMETRY_RANGES, VALID_SEVERITIES
from turnstile.operators import clean
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.sources.canonical import Fleet


@register("w7_dedup_latest")
def w7_dedup_latest(spark, sf_dir):
    d = clean.dedup_latest(Fleet(spark, sf_dir).dirty_telemetry(), ["device_id", "date"])
    return round_doubles(d.select("device_id", "date", "cpu_usage_pct", "signal_strength_dbm"))


@register("w8_exact_dedup")
def w8_exact_dedup(spark, sf_dir):
    e = Fleet(spark, sf_dir).error_logs()
    redelivered = e.unionByName(e.where(F.pmod("event_id", F.lit(4)) == 0))
    return round_doubles(clean.dedup_exact(redelivered))


@register("p3_standardise_text")
def p3_standardise_text(spark, sf_dir):
    d = clean.clean_devices(Fleet(spark, sf_dir).dirty_devices())
    return d.select("device_id", "station", "gate_type", "manufacturer", "age_days", "warranty_remaining_days")


@register("p4_clip")
def p4_clip(spark, sf_dir):
    t = clean.drop_meta(clean.dedup_latest(Fleet(spark, sf_dir).dirty_telemetry(), ["device_id", "date"]))
    return round_doubles(clean.clip_ranges(t, TELEMETRY_RANGES))


@register("p6_silver_telemetry")
def p6_silver_telemetry(spark, sf_dir):
    return round_doubles(clean.clean_telemetry(Fleet(spark, sf_dir).dirty_telemetry()))


@register("p5_silver_error_logs")
def p5_silver_error_logs(spark, sf_dir):
    return round_doubles(clean.clean_error_logs(Fleet(spark, sf_dir).dirty_error_logs()))


@register("p7_silver_maintenance")
def p7_silver_maintenance(spark, sf_dir):
    return round_doubles(clean.clean_maintenance(Fleet(spark, sf_dir).dirty_maintenance()))


@register("q12_quarantine")
def q12_quarantine(spark, sf_dir):
    e = Fleet(spark, sf_dir).dirty_error_logs()
    sev = F.trim(F.upper("severity"))
    _, rejected = clean.quarantine(e, {
        "severity_in_set": (sev.isin(VALID_SEVERITIES), "severity not in LOW/MEDIUM/HIGH/CRITICAL"),
        "resolution_time_present": (F.col("resolution_time_min").isNotNull(), "resolution_time_min is NULL"),
    })
    return rejected.select("event_id", "device_id", "rejection_rule", "rejection_reason", "failed_rules")


@register("j14_orphans")
def j14_orphans(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    raw_maint = f.table("orders").select(F.col("o_orderkey").alias("maintenance_id"),
                                         F.col("o_custkey").alias("device_id"))
    return clean.orphans(raw_maint, f.devices())


@register("b4_null_rules")
def b4_null_rules(spark, sf_dir):
    t = clean.drop_meta(clean.dedup_latest(Fleet(spark, sf_dir).dirty_telemetry(), ["device_id", "date"]))
    valid, _ = clean.null_rules(t, {"signal_strength_dbm": "median", "response_time_ms": "reject"})
    return round_doubles(valid.select("device_id", "date", "signal_strength_dbm", "response_time_ms"))


@register("b5_enum_map")
def b5_enum_map(spark, sf_dir):
    """Seed lookup: canonical maintenance type for the delivered spellings."""
    f = Fleet(spark, sf_dir)
    m = f.dirty_maintenance()
    # a seed file: one row per known spelling (bounded, hand-maintained)
    seeds = spark.createDataFrame(
        [(f" {t.lower()} ", t) for t in ("Preventive", "Corrective", "Emergency", "Firmware_Update")],
        "raw string, canonical string")
    out = clean.enum_map(m, "maintenance_type", seeds)
    return out.groupBy("maintenance_type").agg(F.count(F.lit(1)).alias("n"))
