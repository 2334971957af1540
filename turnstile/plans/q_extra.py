"""Queries that give inventory items used inside larger operators their own result
(S2, S5, S8, P1, P9, P10, P11, P16, J6, T4, U3/U4, U6, M21, C9, B1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from turnstile.functions.exprs import GATE_TYPES
from turnstile.functions.stats import exact_median
from turnstile.operators import cdc, clean, features
from turnstile.operators import patterns as pt
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import scratch_path
from turnstile.sources import ingest, sinks
from turnstile.sources.canonical import Fleet


@register("s2_multi_file_scan")
def s2_multi_file_scan(spark, sf_dir):
    """A bronze table written as one file set per day, read back as one table."""
    t = Fleet(spark, sf_dir).telemetry()
    path = scratch_path(spark, f"bronze/daily-{uuid.uuid4().hex}")
    t.write.mode("overwrite").partitionBy("date").parquet(path)
    return ingest.read_bronze(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@register("s5_incremental_ingest")
def s5_incremental_ingest(spark, sf_dir):
    e = Fleet(spark, sf_dir).error_logs()
    path = scratch_path(spark, f"bronze/errors-{uuid.uuid4().hex}")
    ingest.ingest_incremental(e, path, "timestamp", "2024-01-15", "error_logs_20240115.csv")
    ingest.ingest_incremental(e, path, "timestamp", "2024-01-15", "error_logs_20240115.csv")  # rerun: same result
    b = spark.read.parquet(path)
    return b.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_batch_id").alias("batches"))


@register("s8_parquet_roundtrip")
def s8_parquet_roundtrip(spark, sf_dir):
    m = Fleet(spark, sf_dir).maintenance()
    path = scratch_path(spark, f"silver/maintenance-{uuid.uuid4().hex}")
    sinks.write_parquet(m, path)
    return round_doubles(spark.read.parquet(path).select("maintenance_id", "device_id", "date", "cost_gbp"))


@register("p1_drop_meta")
def p1_drop_meta(spark, sf_dir):
    d = clean.drop_meta(Fleet(spark, sf_dir).dirty_telemetry())
    return round_doubles(d.select("device_id", "date", "cpu_usage_pct", "signal_strength_dbm"))


@register("p9_target_date")
def p9_target_date(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    return round_doubles(t.where(F.col("date") == F.lit("2024-01-15").cast("date")).select(
        "device_id", "date", "error_count", "cpu_usage_pct"))


@register("p10_trailing_window")
def p10_trailing_window(spark, sf_dir):
    """The 30 days before a target date in the middle of what they cover, so that the cutoff acts."""
    t = Fleet(spark, sf_dir).telemetry()
    d = F.lit("2024-02-14").cast("date")
    w = t.where(F.col("date") >= F.date_sub(d, 30))
    return w.groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@register("p11_device_flags")
def p11_device_flags(spark, sf_dir):
    d = Fleet(spark, sf_dir).devices()
    return d.select("device_id", *features.device_flag_exprs())


@register("p16_binarize_median")
def p16_binarize_median(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    med = exact_median(t, ["response_time_ms"])["response_time_ms"]
    return t.select("device_id", "date", (F.col("response_time_ms") > F.lit(med)).cast("int").alias("slow_response"))


@register("j6_key_matching")
def j6_key_matching(spark, sf_dir):
    from turnstile.plans.q_cdc import day_batch

    ch = cdc.detect_changes(Fleet(spark, sf_dir).telemetry(), day_batch(spark, sf_dir), ["device_id", "date"])
    return cdc.change_summary(ch)


@register("u3_u4_key_sets")
def u3_u4_key_sets(spark, sf_dir):
    """Key difference both ways and intersection between two days' device sets."""
    t = Fleet(spark, sf_dir).telemetry()
    a = t.where(F.col("date") == F.lit("2024-01-14").cast("date")).select("device_id")
    b = t.where(F.col("date") == F.lit("2024-01-15").cast("date")).select("device_id")
    only_b = b.join(a, "device_id", "left_anti").select(F.lit("new_only").alias("set"), "device_id")
    only_a = a.join(b, "device_id", "left_anti").select(F.lit("old_only").alias("set"), "device_id")
    both = b.join(a, "device_id", "left_semi").select(F.lit("common").alias("set"), "device_id")
    return only_b.unionByName(only_a).unionByName(both).groupBy("set").agg(F.count(F.lit(1)).alias("devices"))


@register("u6_values_outside_set")
def u6_values_outside_set(spark, sf_dir):
    """Distinct delivered values of a code column that are not in the allowed set."""
    d = Fleet(spark, sf_dir).dirty_devices()
    return d.where(~F.col("gate_type").isin(GATE_TYPES)).select(F.col("gate_type").alias("extra_value")).distinct()


@register("t4_top_rules_by_lift")
def t4_top_rules_by_lift(spark, sf_dir):
    r = pt.association_rules(pt.frequent_itemsets(Fleet(spark, sf_dir).error_logs()), 0.3)
    return round_doubles(r.orderBy(F.col("lift").desc(), "antecedents", "consequents").limit(10).select(
        "antecedents", "consequents", "lift"))


@register("m21_simplified_causal")
def m21_simplified_causal(spark, sf_dir):
    from turnstile.plans.q_ml import a16_high_low_rates

    return a16_high_low_rates(spark, sf_dir)


@register("c9_high_watermark_extract")
def c9_high_watermark_extract(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    target = t.where(F.col("date") <= F.lit("2024-01-20").cast("date"))
    return cdc.new_since(t, target).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@register("b1_batch_metadata")
def b1_batch_metadata(spark, sf_dir):
    t = ingest.with_batch_metadata(Fleet(spark, sf_dir).telemetry(), "telemetry.csv", "run-1", "csv")
    return t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_batch_id").alias("batches"),
                 F.first("_pipeline_run_id").alias("run_id"), F.first("_source").alias("source"))
