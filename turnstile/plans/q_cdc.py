"""Queries: incremental processing and change capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from turnstile.functions.exprs import DELTA_COLS, ROLLING_COLS
from turnstile.operators import cdc
from turnstile.plans.catalog import register
from turnstile.plans.common import round_doubles
from turnstile.sources.canonical import Fleet

DAY = "2024-01-15"
INC_DAY = "2024-01-21"
KEYS = ["device_id", "date"]


def day_batch(spark, sf_dir, day: str = DAY):
    """A re-delivered day: corrected readings (device % 3 == 0: cpu + 1), removed rows
    (device % 7 == 0) and late rows copied from the previous day for devices % 11 == 0
    that had no row on the day."""
    t = Fleet(spark, sf_dir).telemetry()
    d = F.lit(day).cast("date")
    today = t.where(F.col("date") == d)
    did = F.col("device_id")
    changed = today.where(F.pmod(did, F.lit(7)) != 0).withColumn(
        "cpu_usage_pct", F.when(F.pmod(did, F.lit(3)) == 0, F.col("cpu_usage_pct") + 1).otherwise(F.col("cpu_usage_pct")))
    late = (t.where((F.col("date") == F.date_sub(d, 1)) & (F.pmod(did, F.lit(11)) == 0))
            .join(today.select("device_id"), "device_id", "left_anti").withColumn("date", d).select(*t.columns))
    return changed.unionByName(late)


@register("a18_table_hash")
def a18_table_hash(spark, sf_dir):
    """The content hash and whether it sees what it must: not the order of rows, but a value, a moved
    NULL and a repeated row."""
    t = Fleet(spark, sf_dir).telemetry()
    h = cdc.table_hash(t).select("row_count", "content_hash")
    some = F.pmod("device_id", F.lit(50)) == 0
    moved = F.when(some, F.lit(None)).otherwise
    cases = {
        "same_in_other_order": (t.repartition(7, "date").sortWithinPartitions(F.col("device_id").desc()), True),
        "sees_a_value": (t.withColumn("error_count", F.when(some, F.col("error_count") + 1).otherwise(F.col("error_count"))), False),
        "sees_a_null": (t.withColumn("cpu_usage_pct", moved(F.col("cpu_usage_pct"))), False),
        "sees_repeated_rows": (t.unionByName(t.where(some)).unionByName(t.where(some)), False),
    }
    out = h
    for name, (other, same) in cases.items():
        o = cdc.table_hash(other).select(F.col("content_hash").alias("_other"))
        out = out.join(o).withColumn(name, (F.col("content_hash") == F.col("_other")) == F.lit(same)).drop("_other")  # one row each
    return out.drop("content_hash")


@register("c2_watermark_decision")
def c2_watermark_decision(spark, sf_dir):
    """The same day unchanged, the same day changed, a new day, a table without a watermark."""
    b = day_batch(spark, sf_dir)
    h = cdc.table_hash(b).first()
    state = spark.createDataFrame(
        [("telemetry", DAY, h["row_count"], h["content_hash"])],
        "table_name string, last_date string, last_row_count bigint, last_hash bigint").select(
        "table_name", F.col("last_date").cast("date").alias("last_date"), "last_row_count", "last_hash",
        F.current_timestamp().alias("updated_at"))
    more = b.withColumn("error_count", F.col("error_count") + 1)
    cases = [("telemetry", b, DAY), ("telemetry", more, DAY), ("telemetry", more, "2024-01-16"), ("error_logs", b, DAY)]
    made = [cdc.watermark_decision(state, *case) for case in cases]
    return reduce(lambda x, y: x.unionByName(y), made).select("table_name", "batch_date", "row_count", "action")


@register("c3_detect_changes")
def c3_detect_changes(spark, sf_dir):
    ch = cdc.detect_changes(Fleet(spark, sf_dir).telemetry(), day_batch(spark, sf_dir), KEYS)
    return round_doubles(ch.select("device_id", "date", "change_type", "cpu_usage_pct"))


@register("c4_apply_changes")
def c4_apply_changes(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    ch = cdc.detect_changes(t, day_batch(spark, sf_dir), KEYS)
    merged = cdc.apply_changes(t, ch, KEYS)
    return round_doubles(merged.select("device_id", "date", "cpu_usage_pct", "error_count"))


@register("c3_detect_changes_devices")
def c3_detect_changes_devices(spark, sf_dir):
    """A table with DATE values and no date key."""
    d = Fleet(spark, sf_dir).devices()
    did = F.col("device_id")
    snap = d.where(F.pmod(did, F.lit(13)) != 0).withColumn(
        "install_date", F.when(F.pmod(did, F.lit(5)) == 0, F.date_add("install_date", 1)).otherwise(F.col("install_date")))
    return cdc.detect_changes(d, snap).select("device_id", "change_type", "install_date")


@register("c5_cdc_log")
def c5_cdc_log(spark, sf_dir):
    """Three days replayed: one entry each, appended, the newest two kept (90 in production)."""
    t = Fleet(spark, sf_dir).telemetry()
    log = spark.createDataFrame([], cdc.CDC_LOG_SCHEMA)
    for k, day in enumerate(("2024-01-13", "2024-01-14", DAY)):
        ch = cdc.detect_changes(t, day_batch(spark, sf_dir, day), KEYS)
        entry = cdc.cdc_log_entry(ch, "telemetry", day).withColumn("logged_at", F.timestamp_seconds(F.lit(k)))
        log = cdc.append_log(log, entry, keep_last=2)
    return log.drop("logged_at")


@register("c6_incremental_features")
def c6_incremental_features(spark, sf_dir):
    f = Fleet(spark, sf_dir)
    inc = cdc.incremental_features(f.telemetry(), f.gold(), INC_DAY)
    cols = ([f"{c}_7d_mean" for c in ROLLING_COLS] + [f"{c}_7d_std" for c in ROLLING_COLS]
            + [f"{c}_delta" for c in DELTA_COLS]
            + ["cumulative_errors", "cumulative_reboots", "failure_cumsum", "days_since_last_failure", "health_score"])
    return round_doubles(inc.select("device_id", "date", *cols))


@register("c8_incremental_merge")
def c8_incremental_merge(spark, sf_dir):
    t = Fleet(spark, sf_dir).telemetry()
    target = t.where(F.col("date") < F.lit("2024-01-25").cast("date"))
    new = cdc.new_since(t, target)
    merged = cdc.merge_on_keys(target, new, KEYS)
    return round_doubles(merged.select("device_id", "date", "error_count", "signal_strength_dbm"))


@register("b11_device_watermarks")
def b11_device_watermarks(spark, sf_dir):
    return cdc.device_watermarks(Fleet(spark, sf_dir).gold())


@register("b12_scd2_devices")
def b12_scd2_devices(spark, sf_dir):
    d = Fleet(spark, sf_dir).devices()
    tracked = ["station", "firmware_version", "gate_type"]
    dim0 = cdc.scd2_init(d, "device_id", tracked, "2024-01-01")
    did = F.col("device_id")
    snap = d.where(F.pmod(did, F.lit(13)) != 0).withColumn(
        "firmware_version", F.when(F.pmod(did, F.lit(4)) == 3, F.lit("v4.1.0")).otherwise(F.col("firmware_version")))
    dim1 = cdc.scd2_merge(dim0, snap, "device_id", tracked, "2024-02-01")
    return dim1.select("device_id", *tracked, "valid_from", "valid_to", "is_current")
