"""Queries: streaming (ST1-ST7), sources and sinks.

Streaming queries run to completion (``availableNow``) over landing files that
Spark writes from the driver tables under the shared checkpoint folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.session import materialize, mkdirs, scratch_path
from turnstile.sources import ingest, sinks
from turnstile.sources.canonical import Fleet
from turnstile.streaming import changes as ch
from turnstile.streaming import stream as st


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def _thirds(col="ts"):
    """Three deliveries in time order."""
    t = F.col(col).cast("date")
    first, second = F.lit("2024-01-11").cast("date"), F.lit("2024-01-21").cast("date")
    return [t < first, (t >= first) & (t < second), (t >= second) | t.isNull()]


@register("st1_ingest_stream")
def st1_ingest_stream(spark, sf_dir):
    """Three deliveries, with the query stopped and started again between them."""
    ev = Fleet(spark, sf_dir).events
    tag = uuid.uuid4().hex
    landing, bronze, ckpt = (scratch_path(spark, f"{d}/events-{tag}") for d in ("landing", "bronze", "stream"))
    st.land_in_order(ev, landing, _thirds(), lambda: st.ingest_stream(spark, landing, ev.schema, bronze, ckpt))
    b = spark.read.parquet(bronze)
    return b.groupBy("date").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("devices"))


@register("st2_cdc_stream")
def st2_cdc_stream(spark, sf_dir):
    """Telemetry as changes that come in parts, twice and out of order: a correction of one day, in which some
    devices are deleted, overtakes most of the rows that it corrects."""
    t = Fleet(spark, sf_dir).telemetry()
    tag = uuid.uuid4().hex
    landing, path = (scratch_path(spark, f"{d}/telemetry-{tag}") for d in ("landing", "silver"))
    mkdirs(spark, landing)
    table = ch.ChangeTable(spark, path, t.schema, ["device_id", "date"])
    day, part = F.col("date") == F.lit("2024-01-15").cast("date"), F.pmod("device_id", F.lit(3))
    first = t.withColumn(ch.SEQ, F.lit(1).cast("long")).withColumn(ch.DELETED, F.lit(False))
    again = (t.where(day).withColumn("error_count", F.col("error_count") + 1).withColumn(ch.SEQ, F.lit(2).cast("long"))
              .withColumn(ch.DELETED, F.pmod("device_id", F.lit(4)) == 0))
    for rows, compact in ((first.where((part == 0) | ~day & (part == 1)), False), (again, True), (first.where(part > 0), True), (first.where(part < 2), False)):
        rows.write.mode("append").parquet(landing)
        table.step(landing)
        if compact:
            table.compact()
    return round_doubles(table.read().select("device_id", "date", "error_count", "cpu_usage_pct"))


@register("st3_tumbling_counts")
def st3_tumbling_counts(spark, sf_dir):
    return round_doubles(_ntz(st.tumbling_device_counts(Fleet(spark, sf_dir).events, 15),
                              "window_start", "window_end"))


@register("st3_stream_tumbling")
def st3_stream_tumbling(spark, sf_dir):
    ev = Fleet(spark, sf_dir).events
    landing = scratch_path(spark, f"landing/tumbling-{uuid.uuid4().hex}")
    mkdirs(spark, landing)
    s = spark.readStream.schema(ev.schema).parquet(landing)
    table = st.StreamTable(st.tumbling_device_counts(s, 15, lateness="30 minutes"), "tumbling", "update", ["device_id", "window_start"])
    st.land_in_order(ev, landing, _thirds(), table.step)
    return round_doubles(_ntz(table.read(), "window_start", "window_end"))


@register("st4_dedup_stream")
def st4_dedup_stream(spark, sf_dir):
    """Every fifth event is delivered again with the next part."""
    ev = Fleet(spark, sf_dir).events
    landing = scratch_path(spark, f"landing/dedup-{uuid.uuid4().hex}")
    mkdirs(spark, landing)
    s = spark.readStream.schema(ev.schema).parquet(landing)
    table = st.StreamTable(st.dedup_stream(s, ["event_id"], "1 hour"), "dedup")
    thirds = _thirds()
    again = F.pmod("event_id", F.lit(5)) == 0
    st.land_in_order(ev.unionByName(ev.where(again)), landing, [thirds[0]], table.step)
    st.land_in_order(ev, landing, [thirds[1] | (thirds[0] & again), thirds[2] | (thirds[1] & again)], table.step)
    return table.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@register("st5_requests_per_minute")
def st5_requests_per_minute(spark, sf_dir):
    m = st.request_metrics(Fleet(spark, sf_dir).requests(), 1)
    return round_doubles(_ntz(m.drop("p50_ms", "p95_ms", "p99_ms"), "window_start"))


@register("st5_hourly_latency")
def st5_hourly_latency(spark, sf_dir):
    m = st.request_metrics(Fleet(spark, sf_dir).requests(), 60)
    return round_doubles(_ntz(m.select("window_start", "requests", "avg_ms", "max_ms"), "window_start"))


@register("st5_latency_percentiles")
def st5_latency_percentiles(spark, sf_dir):
    m = st.request_metrics(Fleet(spark, sf_dir).requests(), 5)
    return round_doubles(_ntz(m.select("window_start", "p50_ms", "p95_ms", "p99_ms"), "window_start"))


@register("st5_sketched_percentiles")
def st5_sketched_percentiles(spark, sf_dir):
    """Latency sketches stored by minute, merged to 5 minutes, hours and days: does each percentile lie
    within the stated rank error of the requests of its window, counted one by one?"""
    r = Fleet(spark, sf_dir).requests()
    minutes = materialize(st.minute_sketches(r), "latency-sketches")
    out = None
    for size, window in ((5, "5 minutes"), (60, "1 hour"), (1440, "1 day")):
        m = st.merged_windows(minutes, window).select("window_start", "requests", "p50_ms", "p95_ms", "p99_ms")
        each = st.event_time(r).select(F.window("ts", window)["start"].alias("window_start"), F.col("duration_ms").cast("double").alias("v")).join(m, "window_start")
        within = []
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            below, upto = F.avg((F.col("v") < F.col(f"{name}_ms")).cast("double")), F.avg((F.col("v") <= F.col(f"{name}_ms")).cast("double"))
            within.append(((below <= q + 2 * st.RANK_ERROR) & (upto >= q - 2 * st.RANK_ERROR)).alias(f"{name}_within"))
        checked = each.groupBy("window_start", "requests").agg(*within).select(F.lit(size).alias("minutes"), "*")
        out = checked if out is None else out.unionByName(checked)
    return _ntz(out, "window_start")


@register("st5_requests_by_name")
def st5_requests_by_name(spark, sf_dir):
    return round_doubles(st.requests_by_name(Fleet(spark, sf_dir).requests()))


@register("st6_sliding_alerts")
def st6_sliding_alerts(spark, sf_dir):
    a = st.sliding_alerts(Fleet(spark, sf_dir).requests(), "5 minutes", "1 minute", 0.1, 1000.0)
    return round_doubles(_ntz(a.select("window_start", "window_end", "requests", "error_rate",
                                       F.array_join("alerts", ",").alias("alerts")), "window_start", "window_end"))


@register("st7_escalation_stream")
def st7_escalation_stream(spark, sf_dir):
    """Three deliveries; every third event of the last hours of one comes late, with the next, in the order it likes."""
    e = Fleet(spark, sf_dir).error_logs()
    e = e.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    landing, path = (scratch_path(spark, f"{d}/errors-{uuid.uuid4().hex}") for d in ("landing", "stream"))
    mkdirs(spark, landing)
    table = ch.EscalationTable(spark.readStream.schema(e.schema).parquet(landing), "6 hours", path)
    thirds = _thirds("timestamp")
    soon = F.col("timestamp") + F.expr("INTERVAL 5 HOURS")
    late = F.coalesce((F.pmod("event_id", F.lit(3)) == 0) & (F.to_date(soon) != F.to_date("timestamp"))
                      & F.to_date(soon).isin(dt.date(2024, 1, 11), dt.date(2024, 1, 21)), F.lit(False))
    st.land_in_order(e, landing, [thirds[0] & ~late, thirds[0] & late | thirds[1] & ~late, thirds[1] & late | thirds[2]], table.step)
    table.finish()
    return _ntz(table.read(), "ts")


# ------------------------------------------------------------------ sources / sinks
@register("s1_csv_roundtrip")
def s1_csv_roundtrip(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    path = scratch_path(spark, f"raw/telemetry-{uuid.uuid4().hex}")
    sinks.write_csv(t, path)
    back = ingest.read_csv(spark, path, t.schema)
    return round_doubles(back)


@register("s4_bronze_ingest")
def s4_bronze_ingest(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    path = scratch_path(spark, f"bronze/telemetry-{uuid.uuid4().hex}")
    ingest.ingest_full(t, path, "telemetry.csv", "date")
    ingest.ingest_incremental(t, path, "date", "2024-01-15", "telemetry_20240115.csv")
    b = ingest.read_bronze(spark, path)
    return b.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("device_id").alias("devices"))


@register("s6_manifest")
def s6_manifest(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    tag = uuid.uuid4().hex
    tables = {}
    for name, df, col in (("telemetry", f.telemetry(), "date"), ("error_logs", f.error_logs(), "timestamp")):
        p = scratch_path(spark, f"bronze/{name}-{tag}")
        ingest.ingest_full(df, p, f"{name}.csv", col)
        tables[name] = p
    return ingest.manifest(spark, tables)


@register("s10_json_roundtrip")
def s10_json_roundtrip(spark, sf_dir):
    from turnstile.operators import scoring as sc

    latest = sc.latest_per_device(Fleet(spark, sf_dir).gold())
    docs = sc.root_cause(latest).select("device_id", "risk_factors", "total_risk_factors", "primary_cause")
    path = scratch_path(spark, f"json/root_cause-{uuid.uuid4().hex}")
    sinks.write_json(docs, path)
    back = sinks.read_json(spark, path, docs.schema)
    return back.select("device_id", "total_risk_factors", "primary_cause", F.size("risk_factors").alias("n_factors"))


@register("s12_prediction_snapshot")
def s12_prediction_snapshot(spark, sf_dir):
    from turnstile.operators import survival as sv
    from turnstile.plans.q_survival import LAMBDA, RHO, _surv, _whole_fleet

    rul = sv.rul(_surv(spark, sf_dir), LAMBDA, RHO).select("device_id", "rul_median_days")
    preds = _whole_fleet(spark, sf_dir).join(rul, "device_id").select(
        "device_id", "date", "failure_probability", "failure_risk_tier", F.col("is_anomaly").cast("int").alias("anomaly_label"),
        "anomaly_score", "rul_median_days", F.col("risk_tier").alias("sla_risk_tier"), "sla_risk_score")
    return round_doubles(sinks.prediction_snapshot(preds, scratch_path(spark, f"predictions/{uuid.uuid4().hex}"), "2024-01-30"))


@register("s12_prediction_snapshot_fitted")
def s12_prediction_snapshot_fitted(spark, sf_dir):
    """The daily snapshot from the fitted models: the champion's probability, the forest's label and score, the Weibull RUL and its SLA risk."""
    from turnstile.functions.exprs import np_round
    from turnstile.operators import failure as fm
    from turnstile.operators import scoring as sc
    from turnstile.operators import survival as sv
    from turnstile.plans.q_anomaly import _stored_labels
    from turnstile.plans.q_ml import _latest_pred
    from turnstile.plans.q_survival import _fitted_rul, _surv

    failure = fm.batch_scores(_latest_pred(spark, sf_dir)).select(
        "device_id", "date", np_round(F.col("score"), 4).alias("failure_probability"), F.col("risk_tier").alias("failure_risk_tier"))
    labels = sc.latest_per_device(_stored_labels(spark, sf_dir).select("device_id", "date", "anomaly_label", "anomaly_score")).drop("date")
    sla = sv.sla_risk(_surv(spark, sf_dir), _fitted_rul(spark, sf_dir)).select(
        "device_id", "rul_median_days", F.col("risk_tier").alias("sla_risk_tier"), "sla_risk_score")
    preds = failure.join(labels, "device_id").join(sla, "device_id").select(
        "device_id", "date", "failure_probability", "failure_risk_tier", "anomaly_label", "anomaly_score", "rul_median_days", "sla_risk_tier", "sla_risk_score")
    return round_doubles(sinks.prediction_snapshot(preds, scratch_path(spark, f"predictions/{uuid.uuid4().hex}"), "2024-01-30"))


@register("s13_serving_read")
def s13_serving_read(spark, sf_dir):
    """A ratio to zero as IEEE gives it: infinities, NaN and NULL all reach the reader as 0."""
    g = Fleet(spark, sf_dir).gold().select("device_id", "date", "signal_strength_dbm_7d_std", "error_count_delta")
    d, inf = F.col("error_count_delta"), F.lit(float("inf"))
    x = g.withColumn("ratio", F.when(d > 0, inf).when(d < 0, -inf).when(F.pmod("device_id", F.lit(2)) == 0, F.lit(float("nan"))))
    return round_doubles(sinks.serving_read(x))


@register("s11_export")
def s11_export(spark, sf_dir):
    """All three feature sets written and read back: rows, columns, devices."""
    root = scratch_path(spark, f"feature-sets/{uuid.uuid4().hex}")
    made = sinks.export_feature_sets(Fleet(spark, sf_dir).gold(), root)
    out = None
    for name, path in made.items():
        t = spark.read.parquet(path)
        r = t.agg(F.lit(name).alias("feature_set"), F.count(F.lit(1)).alias("rows"), F.lit(len(t.columns)).alias("columns"),
                  F.count_distinct("device_id").alias("devices"))
        out = r if out is None else out.unionByName(r)
    return out


@register("st5_anomalies_per_hour")
def st5_anomalies_per_hour(spark, sf_dir):
    """Hourly share of anomalous requests (slower than 90 ms)."""
    r = Fleet(spark, sf_dir).requests().withColumn("is_anomaly", F.col("duration_ms") > 90)
    return round_doubles(_ntz(st.anomaly_rate(r, 60), "window_start"))


@register("st6_latency_alerts")
def st6_latency_alerts(spark, sf_dir):
    """The latency rule alone, at a limit that windows break."""
    a = st.sliding_alerts(Fleet(spark, sf_dir).requests(), "5 minutes", "1 minute", 2.0, 60.0)
    return round_doubles(_ntz(a.select("window_start", "window_end", "requests", "p99_ms",
                                       F.array_join("alerts", ",").alias("alerts")), "window_start", "window_end"))


@register("st6_metric_alerts")
def st6_metric_alerts(spark, sf_dir):
    """Scalar alerts over the fleet's own drift share, quality pass rate and devices at risk."""
    from turnstile.plans.catalog import QUERIES

    q = lambda name: QUERIES[name](spark, sf_dir)
    values = q("d4_drift_share").select(F.lit("drift_share").alias("metric"), F.col("drift_share").alias("value"))
    values = values.unionByName(q("q10_summary").where("layer = 'overall'").select(
        F.lit("quality_pass_rate").alias("metric"), (F.col("passed") / F.col("total") * 100).alias("value")))
    values = values.unionByName(q("a13_rul_fleet_metrics").select(
        F.lit("devices_at_risk").alias("metric"), (F.col("critical_devices") + F.col("high_devices")).cast("double").alias("value")))
    return round_doubles(st.metric_alerts(values))


@register("b3_schema_evolution")
def b3_schema_evolution(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    path = scratch_path(spark, f"bronze/evolving-{uuid.uuid4().hex}")
    old = t.where(F.col("date") < F.lit("2024-01-15").cast("date"))
    new = t.where(F.col("date") >= F.lit("2024-01-15").cast("date")).withColumn(
        "firmware_channel", F.when(F.pmod("device_id", F.lit(2)) == 0, "stable").otherwise("beta"))
    old.write.mode("overwrite").parquet(f"{path}/part=old")
    new.write.mode("overwrite").parquet(f"{path}/part=new")
    merged = ingest.read_bronze(spark, path)
    added = [c for c, change, _ in ingest.schema_diff(old.schema, merged.schema) if change == "added"]
    return merged.groupBy("firmware_channel").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "added_columns", F.lit(",".join(sorted(added))))
