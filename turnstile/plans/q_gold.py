"""Queries for the gold feature layer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.operators import features as feat
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.sources.canonical import Fleet


def gold(spark, sf_dir):
    return Fleet(spark, sf_dir).gold()


@register("w1_rolling_mean")
def w1_rolling_mean(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    return round_doubles(t.select("device_id", "date", *feat.rolling_exprs(stats=("mean",))))


@register("w2_rolling_std")
def w2_rolling_std(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    return round_doubles(t.select("device_id", "date", *feat.rolling_exprs(stats=("std",))))


@register("w3_delta")
def w3_delta(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    return round_doubles(t.select("device_id", "date", *feat.delta_exprs()))


@register("w4_cumulative")
def w4_cumulative(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    cum = feat.cumulative_exprs()
    return t.select("device_id", "date", *cum[:3])


@register("w5_days_since_failure")
def w5_days_since_failure(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    cum = feat.cumulative_exprs()
    return t.select("device_id", "date", cum[2], cum[3])


@register("w6_failure_next_3d")
def w6_failure_next_3d(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    return t.select("device_id", "date", feat.failure_next_3d_as_coded().alias("failure_next_3d"))


@register("p12_health_score")
def p12_health_score(spark, sf_dir):
    from turnstile.functions.exprs import health_score
    t = Fleet(spark, sf_dir).telemetry()
    return round_doubles(t.select("device_id", "date", health_score(True).alias("health_score")))


@register("a1_severity_pivot")
def a1_severity_pivot(spark, sf_dir):
    e = Fleet(spark, sf_dir).error_logs()
    d = feat.error_day_features(e)
    return d.select("device_id", "date", *[c for c in d.columns if c.startswith("error_") and c.endswith("_count")])


@register("a2_mode")
def a2_mode(spark, sf_dir):
    d = feat.error_day_features(Fleet(spark, sf_dir).error_logs())
    return d.select("device_id", "date", "top_error_code")


@register("a3_distinct_codes")
def a3_distinct_codes(spark, sf_dir):
    d = feat.error_day_features(Fleet(spark, sf_dir).error_logs())
    return d.select("device_id", "date", "unique_error_types")


@register("a4_resolution_rate")
def a4_resolution_rate(spark, sf_dir):
    d = feat.error_day_features(Fleet(spark, sf_dir).error_logs())
    return round_doubles(d.select("device_id", "date", "error_resolution_rate"))


@register("a5_maintenance_rollup")
def a5_maintenance_rollup(spark, sf_dir):
    return round_doubles(feat.maintenance_rollup(Fleet(spark, sf_dir).maintenance()))


@register("j1_error_join")
def j1_error_join(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    j = feat.join_error_features(f.telemetry(), feat.error_day_features(f.error_logs()))
    return round_doubles(j.select("device_id", "date", "error_count", *feat.ERROR_FEATURE_COLS))


@register("j2_maintenance_join")
def j2_maintenance_join(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    j = feat.join_maintenance_features(f.telemetry(), feat.maintenance_rollup(f.maintenance()))
    return round_doubles(j.select("device_id", "date", *feat.MAINT_COLS))


@register("j3_device_join")
def j3_device_join(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    j = feat.join_device_features(f.telemetry(), f.devices())
    return j.select("device_id", "date", *feat.DEVICE_COLS, "is_old_device", "is_beta_firmware",
                    "is_under_warranty", "is_high_traffic_station")


@register("gold_features")
def gold_features(spark, sf_dir):
    """The flagship: the whole gold table computed from the raw tables (not the written copy)."""
    return round_doubles(Fleet(spark, sf_dir).gold_plan())


@register("b6_rolling_multi")
def b6_rolling_multi(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    cols = ["response_time_ms", "error_count"]
    exprs = []
    for n in (7, 14, 30):
        exprs += feat.rolling_exprs(cols, rows=n, stats=("mean", "std", "min", "max"))
    return round_doubles(t.select("device_id", "date", *exprs))


@register("b7_calendar")
def b7_calendar(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry().select("device_id", "date")
    return feat.calendar_features(t)


@register("b8_maintenance_windows")
def b8_maintenance_windows(spark, sf_dir):
    m = Fleet(spark, sf_dir).maintenance()
    r = feat.maintenance_window_features(m, 30)
    return round_doubles(r.select("maintenance_id", "device_id", "date", "cost_30d", "running_maintenance_count"))


@register("b9_failure_within_3d")
def b9_failure_within_3d(spark, sf_dir):
    """Label from maintenance events: a corrective or emergency job of the device within the next 3 days."""
    f = Fleet(spark, sf_dir)
    # the stand-in table's jobs lie years before the readings: their dates are folded into the readings' month
    jobs = f.maintenance().withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("maintenance_id", F.lit(30)).cast("int")))
    return feat.maintenance_label(f.telemetry().select("device_id", "date"), jobs)


@register("j13_dbt_label")
def j13_dbt_label(spark, sf_dir):
    """EXISTS a row of the same device dated +1..+3 days with error_count >= 5 (as a range frame)."""
    t = Fleet(spark, sf_dir).telemetry()
    return t.select("device_id", "date", feat.lookahead_flag(F.col("error_count") >= 5).alias("will_fail_3d"))


@register("w14_dbt_rolling")
def w14_dbt_rolling(spark, sf_dir):
    """dbt macros: rolling avg/stddev (NULL kept), lag delta (NULL on first row), running sum."""
    t = Fleet(spark, sf_dir).telemetry()
    w = feat.device_window()
    frame = w.rowsBetween(-6, 0)
    return round_doubles(t.select(
        "device_id", "date",
        F.avg("response_time_ms").over(frame).alias("response_time_ms_rolling_avg"),
        F.stddev_samp("response_time_ms").over(frame).alias("response_time_ms_rolling_std"),
        (F.col("error_count") - F.lag("error_count").over(w)).alias("error_count_delta"),
        F.sum("error_count").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("error_count_running"),
    ))

