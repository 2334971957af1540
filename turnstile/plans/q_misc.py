"""Queries: remaining inventory items (P2, P13, P14, P24, J12, A23, A26, A27, W15, T2, T5,
Q13, M33, C7, C9, C10, B2, B14, B16, S7)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.functions.exprs import health_score, severity_rank
from turnstile.operators import anomaly as an
from turnstile.operators import cdc, clean, quality
from turnstile.operators import scoring as sc
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import scratch_path
from turnstile.sources import ingest
from turnstile.sources.canonical import Fleet


@register("p2_safe_casts")
def p2_safe_casts(spark, sf_dir):
    """Text columns cast with try_cast; unparsable values are counted per column, not fatal."""
    e = Fleet(spark, sf_dir).events
    raw = e.select(F.col("event_id").cast("string").alias("event_id"),
                   F.when(F.pmod("event_id", F.lit(50)) == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
                   F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    casts = {"event_id": "bigint", "value": "double", "ts": "timestamp"}
    bad = clean.cast_rejects(raw, casts)
    typed = clean.cast_columns(raw, casts)
    return typed.agg(F.count(F.lit(1)).alias("rows"), F.count(F.col("value")).alias("values_parsed"),
                     F.lit(bad.count()).cast("bigint").alias("rejected_rows"))


@register("p13_health_daily")
def p13_health_daily(spark, sf_dir):
    """Daily-run health score: clipped signal/uptime inputs, not rounded (same as the SQL macro)."""
    t = clean.dedup_latest(Fleet(spark, sf_dir).dirty_telemetry(), ["device_id", "date"])
    return round_doubles(t.select("device_id", "date", health_score(rounded=False, clip_inputs=True).alias("health_score")))


@register("p14_label_encode")
def p14_label_encode(spark, sf_dir):
    """Sorted distinct values -> 0..n-1 (the same codes the model pipeline's indexer assigns)."""
    from pyspark.ml.feature import StringIndexer

    d = Fleet(spark, sf_dir).devices().select("device_id", "manufacturer")
    m = StringIndexer(inputCol="manufacturer", outputCol="code", stringOrderType="alphabetAsc").fit(d)
    return m.transform(d).select("device_id", "manufacturer", F.col("code").cast("int").alias("manufacturer_code"))


@register("p24_sla_breach_flag")
def p24_sla_breach_flag(spark, sf_dir):
    m = Fleet(spark, sf_dir).maintenance()
    return m.select("maintenance_id", "device_id", (F.lit(1) - F.col("sla_met")).alias("sla_breach"))


def _dbt_errors(spark, sf_dir):
    e = Fleet(spark, sf_dir).error_logs()
    return e.groupBy("device_id", F.to_date("timestamp").alias("error_date")).agg(
        F.count(F.lit(1)).alias("daily_error_events"),
        F.count_distinct("error_code").alias("unique_error_codes"),
        F.max(severity_rank("severity", sql_model=True)).alias("max_severity"),
        F.sum(F.when(F.col("severity").isin("HIGH", "CRITICAL"), 1).otherwise(0)).alias("critical_errors"))


@register("a27_dbt_daily_errors")
def a27_dbt_daily_errors(spark, sf_dir):
    return _dbt_errors(spark, sf_dir)


@register("j12_dbt_daily_metrics")
def j12_dbt_daily_metrics(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry().select("device_id", F.col("date").alias("reading_date"), "error_count")
    e = _dbt_errors(spark, sf_dir).withColumnRenamed("error_date", "reading_date")
    j = t.join(e, ["device_id", "reading_date"], "left")
    return j.fillna(0, subset=["daily_error_events", "unique_error_codes", "max_severity", "critical_errors"])


@register("w15_dbt_dedup")
def w15_dbt_dedup(spark, sf_dir):
    """Staging dedup: one row per (device, date) among re-deliveries; the latest delivery wins
    (the SQL model's order inside the partition is constant, so a stable order is added)."""
    t = Fleet(spark, sf_dir).dirty_telemetry()
    w = Window.partitionBy("device_id", "date").orderBy(F.col("_ingested_at").desc())
    # partitions are (device, day): bounded by re-deliveries of one reading
    d = t.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return round_doubles(d.select(
        "device_id", "date", F.least(F.greatest(F.col("tap_success_rate"), F.lit(0.0)), F.lit(1.0)).alias("tap_success_rate"),
        "cpu_usage_pct"))


@register("a23_spc_totals")
def a23_spc_totals(spark, sf_dir):
    s = an.spc_summary(Fleet(spark, sf_dir).gold())
    return s.agg(F.sum("violations").alias("total_violations"), F.sum("warnings").alias("total_warnings"))


@register("t2_top_devices_by_sla")
def t2_top_devices_by_sla(spark, sf_dir):
    s = sc.sla_rule_score(sc.latest_per_device(Fleet(spark, sf_dir).gold()))
    return round_doubles(s.orderBy(F.col("sla_risk_score").desc(), "device_id").limit(5).select(
        "device_id", "sla_risk_score", "risk_tier"))


@register("t2_top_transitions")
def t2_top_transitions(spark, sf_dir):
    from turnstile.operators import patterns as pt

    tp = pt.significant_transitions(Fleet(spark, sf_dir).error_logs())
    return round_doubles(tp.orderBy(F.col("probability").desc(), F.col("count").desc(), "from_error", "to_error").limit(10))


@register("t5_highest_risk_device")
def t5_highest_risk_device(spark, sf_dir):
    s = sc.sla_rule_score(sc.latest_per_device(Fleet(spark, sf_dir).gold()))
    return round_doubles(s.agg(F.max_by(F.struct("device_id", "sla_risk_score"),
                                        F.struct("sla_risk_score", F.col("device_id"))).alias("m"))
                         .select("m.device_id", "m.sla_risk_score"))


@register("q13_dbt_tests")
def q13_dbt_tests(spark, sf_dir):
    g = Fleet(spark, sf_dir).gold()
    exps = [quality.not_null("device_id"), quality.not_null("date"), quality.not_null("health_score"),
            quality.between("health_score", 0, 100), quality.not_null("signal_strength_dbm_7d_mean"),
            quality.between("signal_strength_dbm_7d_mean", 0, 100), quality.not_null("failure_next_3d"),
            quality.in_set("failure_next_3d", [0, 1]), quality.mean_between("failure_next_3d", 0.02, 0.15)]
    keys = g.groupBy("device_id", "date").count().agg(F.max("count").alias("m")).select(
        F.lit("dbt").alias("layer"), F.lit("device_features").alias("table"), F.lit(len(exps)).alias("check_id"),
        F.lit("unique(device_id, date)").alias("expectation"), (F.col("m") == 1).alias("success"),
        F.col("m").cast("double").alias("observed"))
    return round_doubles(quality.validate(g, exps, "dbt", "device_features").unionByName(keys))


@register("m33_annotated_anomalies")
def m33_annotated_anomalies(spark, sf_dir):
    """Annotated rows written by day and read back (rule labels, so that SQL can follow them)."""
    from turnstile.plans.q_anomaly import _rule_labeled
    from turnstile.sources.sinks import write_parquet

    path = scratch_path(spark, f"gold/anomalies-{uuid.uuid4().hex}")
    write_parquet(_rule_labeled(spark, sf_dir), path, ["date"])
    back = spark.read.parquet(path)
    return round_doubles(back.select("device_id", "date", "health_score", "anomaly_score", "anomaly_label"))


@register("c7_training_log")
def c7_training_log(spark, sf_dir):
    """Three daily runs replayed: each reads the log's last training, decides, and appends if it trains."""
    from turnstile.operators import drift as dr
    from turnstile.plans.q_drift import _ks

    dec = dr.retrain_decision(dr.drift_share(_ks(spark, sf_dir))).first()  # one decision row
    log = spark.createDataFrame([], "run_date date, reason string, models int, logged_at timestamp")
    for day in ("2024-01-01", "2024-01-08", "2024-01-16"):
        last = log.agg(F.max("run_date").alias("last_retrain_date"))
        state = last.select(F.lit(day).cast("date").alias("current_date"), "last_retrain_date", F.lit(False).alias("force"),
                            F.lit(bool(dec["should_retrain"])).alias("drift_retrain"), F.lit(float(dec["drift_share"])).alias("drift_share"))
        r = dr.retrain_rule(state).first()  # one decision row
        if r["retrain"]:
            log = log.unionByName(cdc.training_log_entry(spark, day, r["reason"], 3))
    return log.drop("logged_at")


@register("c10_idempotent_write")
def c10_idempotent_write(spark, sf_dir):
    """Writing the same day twice replaces that day's partition only (row counts stay put)."""
    t = Fleet(spark, sf_dir).telemetry()
    path = scratch_path(spark, f"silver/idem-{uuid.uuid4().hex}")
    cdc.write_partitions(t, path)
    day = t.where(F.col("date") == F.lit("2024-01-15").cast("date"))
    cdc.write_partitions(day, path)
    cdc.write_partitions(day, path)
    return spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@register("b2_batch_manifest")
def b2_batch_manifest(spark, sf_dir):
    from turnstile.plans.q_cdc import day_batch

    return ingest.batch_manifest(day_batch(spark, sf_dir), "2024-01-14").drop("content_hash")


@register("s7_watermarked_ingest")
def s7_watermarked_ingest(spark, sf_dir):
    """Both tables ingested day by day with a persisted watermark: two days, a re-delivery (skipped) and a
    corrected day (reprocessed).  Returns what the bronze tables hold and how often each was written."""
    f = Fleet(spark, sf_dir)
    tag = uuid.uuid4().hex
    state_path = scratch_path(spark, f"state/watermarks-{tag}")
    out = None
    for table, df, col in (("telemetry", f.telemetry(), "date"), ("error_logs", f.error_logs(), "timestamp")):
        path = scratch_path(spark, f"bronze/{table}-{tag}")
        first = df.where(F.to_date(col) == F.lit("2024-01-14").cast("date"))
        second = df.where(F.to_date(col) == F.lit("2024-01-15").cast("date"))
        fixed = second.where(F.pmod("device_id", F.lit(5)) != 0)
        done = [ingest.ingest_watermarked(spark, table, batch, path, state_path, col, day)
                for batch, day in ((first, "2024-01-14"), (second, "2024-01-15"), (second, "2024-01-15"), (fixed, "2024-01-15"))]
        r = spark.read.parquet(path).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                                         F.lit(",".join(done)).alias("actions"))
        out = r if out is None else out.unionByName(r)
    return out


@register("b14_predictions_vs_outcomes")
def b14_predictions_vs_outcomes(spark, sf_dir):
    """Rule tiers issued on each day vs failures observed in the next 7 days: precision per tier."""
    from turnstile.operators.features import lookahead_flag

    g = Fleet(spark, sf_dir).gold()
    s = sc.sla_rule_score(g.select("device_id", "date", "health_score", "cumulative_errors", "age_days",
                                   "total_maintenance_count", "emergency_count", "failure_today"))
    o = s.select("risk_tier", lookahead_flag(F.col("failure_today") == 1, 1, 7).alias("failed_within_7d"))
    return round_doubles(o.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("predictions"),
                                                    F.avg(F.col("failed_within_7d").cast("double")).alias("precision")))


@register("b14_rul_within_7d")
def b14_rul_within_7d(spark, sf_dir):
    """Rule RUL of each device-day against the days to the device's next failure, per tier: share within 7 days."""
    g = Fleet(spark, sf_dir).gold()
    s = sc.sla_rule_score(g.select("device_id", "date", "health_score", "cumulative_errors", "age_days",
                                   "total_maintenance_count", "emergency_count", "failure_today"))
    # the next failure: a growing frame over the device's days from the last to the first
    w = Window.partitionBy("device_id").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.min(F.when(F.col("failure_today") == 1, F.col("date"))).over(w)
    o = s.select("risk_tier", "rul_estimate_days", F.datediff(nxt, "date").alias("days")).where("days IS NOT NULL")
    return round_doubles(o.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg((F.abs(F.col("rul_estimate_days") - F.col("days")) <= 7).cast("double")).alias("within_7d")))


@register("t2_top_anomalous_devices")
def t2_top_anomalous_devices(spark, sf_dir):
    from turnstile.plans.q_anomaly import a8_device_anomalies

    return a8_device_anomalies(spark, sf_dir).orderBy(F.col("anomaly_count").desc(), "device_id").limit(5)


@register("b16_monthly_report")
def b16_monthly_report(spark, sf_dir):
    g = Fleet(spark, sf_dir).gold()
    return round_doubles(g.groupBy(F.date_trunc("month", F.col("date")).cast("date").alias("month")).agg(
        F.count_distinct("device_id").alias("devices"), F.count(F.lit(1)).alias("device_days"),
        F.sum("failure_today").alias("failures"), F.avg("health_score").alias("mean_health"),
        F.sum("error_count").alias("errors")))


@register("a26_daily_sla_summary")
def a26_daily_sla_summary(spark, sf_dir):
    """Per day: devices per rule tier and mean RUL over that day's rows."""
    g = Fleet(spark, sf_dir).gold()
    s = sc.sla_rule_score(g)
    return round_doubles(s.groupBy("date").agg(
        *[F.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_devices") for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
        F.avg("rul_estimate_days").alias("mean_rul")))
