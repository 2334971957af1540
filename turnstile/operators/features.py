"""Gold feature engineering: per-device windows, device-day error rollups, joins.

Every per-device window shares one ``WindowSpec`` (partition ``device_id``,
order ``date``), so the whole block plans as one Exchange + one Sort.  The
joins are ordered so that the last shuffle (hash on ``device_id``) is reused by
the windows instead of re-shuffling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.exprs import (
    BETA_FIRMWARE,
    DELTA_COLS,
    HIGH_TRAFFIC_STATIONS,
    ROLLING_COLS,
    VALID_SEVERITIES,
    as_int_flag,
    health_score,
)

KEY = "device_id"


def device_window(order: str = "date", key: str = KEY):
    return Window.partitionBy(key).orderBy(order)


# ---------------------------------------------------------------- W1 / W2 / B6
def rolling_exprs(cols=ROLLING_COLS, rows: int = 7, stats=("mean", "std"), order: str = "date",
                  key: str = KEY, suffix: str | None = None) -> list[Column]:
    """``rows``-row trailing frame per device (min 1 row); std of one row is 0."""
    frame = device_window(order, key).rowsBetween(-(rows - 1), 0)
    tag = suffix or f"{rows}d"
    out = []
    for c in cols:
        for s in stats:
            if s == "mean":
                e = F.avg(c).over(frame)
            elif s == "std":
                e = F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0))
            elif s == "min":
                e = F.min(c).over(frame)
            elif s == "max":
                e = F.max(c).over(frame)
            else:
                raise ValueError(s)
            out.append(e.alias(f"{c}_{tag}_{s}"))
    return out


def rolling_features(df: DataFrame, cols=ROLLING_COLS, rows: int = 7, stats=("mean", "std"),
                     order: str = "date", key: str = KEY) -> DataFrame:
    return df.select("*", *rolling_exprs(cols, rows, stats, order, key))


# ---------------------------------------------------------------- W3
def delta_exprs(cols=DELTA_COLS, order: str = "date", key: str = KEY, fill_first: bool = True) -> list[Column]:
    w = device_window(order, key)
    out = []
    for c in cols:
        d = F.col(c) - F.lag(c).over(w)
        out.append((F.coalesce(d, F.lit(0)) if fill_first else d).alias(f"{c}_delta"))
    return out


# ---------------------------------------------------------------- W4 / W5 / W6
def cumulative_exprs(order: str = "date", key: str = KEY) -> list[Column]:
    w = device_window(order, key)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rn = F.row_number().over(w)
    last_fail_rn = F.max(F.when(F.col("failure_today") == 1, rn)).over(run)
    return [
        F.sum("error_count").over(run).alias("cumulative_errors"),
        F.sum("reboot_count").over(run).alias("cumulative_reboots"),
        F.sum("failure_today").over(run).alias("failure_cumsum"),
        # rows since the last failure (0 on a failure row, counts from 0 before the first)
        (rn - F.coalesce(last_fail_rn, F.lit(1))).cast("int").alias("days_since_last_failure"),
    ]


def failure_next_3d_as_coded(order: str = "date", key: str = KEY) -> Column:
    """max(failure_today) over rows -1..+1, last row 0 (the executed label)."""
    w = device_window(order, key)
    return (F.when(F.lead("failure_today").over(w).isNull(), F.lit(0))
            .otherwise(F.max("failure_today").over(w.rowsBetween(-1, 1))).cast("int"))


def day_number(c: str = "date") -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def lookahead_flag(cond: Column, days_from: int = 1, days_to: int = 3, key: str = KEY,
                   date_col: str = "date") -> Column:
    """1 if ``cond`` holds on a row of the same device dated +from..+to days ahead.

    A range frame on the day number replaces the correlated EXISTS self-join.
    """
    w = Window.partitionBy(key).orderBy(day_number(date_col)).rangeBetween(days_from, days_to)
    return F.coalesce(F.max(as_int_flag(cond)).over(w), F.lit(0)).cast("int")


def maintenance_label(days: DataFrame, maintenance: DataFrame, within: int = 3) -> DataFrame:
    """``days`` (device_id, date) plus failure_within_3d: 1 if the device has a corrective or emergency
    job dated +1..+``within`` days.  Each job marks the days before it: an equi-join, no range join."""
    jobs = maintenance.where(F.col("maintenance_type").isin("Corrective", "Emergency"))
    marked = jobs.select("device_id", F.explode(F.array(*[F.date_sub("date", k) for k in range(1, within + 1)])).alias("date")).distinct()
    return days.join(marked.withColumn("_hit", F.lit(1)), ["device_id", "date"], "left").select(
        "device_id", "date", F.coalesce("_hit", F.lit(0)).alias("failure_within_3d"))


def telemetry_features(t: DataFrame) -> DataFrame:
    """W1-W6 + P12 on clean telemetry (one window spec for everything)."""
    return t.select(
        "*",
        *rolling_exprs(),
        *delta_exprs(),
        *cumulative_exprs(),
        health_score(rounded=True).alias("health_score"),
        failure_next_3d_as_coded().alias("failure_next_3d"),
    )


# ---------------------------------------------------------------- A1-A4
def error_day_features(errors: DataFrame) -> DataFrame:
    """Per device-day: counts by severity, modal code (ties -> smallest),
    distinct code count and resolution rate.

    Rows are counted by device, day and code first.  Modes and sets as aggregates hold an object a group, and
    millions of device-days would be sorted and serialised one by one."""
    sev, code = F.col("severity"), F.col("error_code")
    resolved = F.col("resolved").cast("double")
    counts = [f"error_{s.lower()}_count" for s in VALID_SEVERITIES]
    by_code = errors.groupBy("device_id", F.to_date("timestamp").alias("date"), "error_code").agg(
        *[F.count_if(sev == s).alias(c) for s, c in zip(VALID_SEVERITIES, counts)],
        F.count(F.lit(1)).alias("_n"), F.sum(resolved).alias("_resolved"), F.count(resolved).alias("_known"))
    order = F.when(code.isNotNull(), F.struct(-F.col("_n"), code))
    known = F.sum("_known")
    return by_code.groupBy("device_id", "date").agg(
        *[F.sum(c).cast("int").alias(c) for c in counts],
        F.min_by("error_code", order).alias("top_error_code"),
        F.count("error_code").cast("int").alias("unique_error_types"),
        F.when(known > 0, F.sum("_resolved") / known).alias("error_resolution_rate"))


ERROR_FEATURE_COLS = [f"error_{s.lower()}_count" for s in VALID_SEVERITIES] + [
    "top_error_code", "unique_error_types", "error_resolution_rate"]


def join_error_features(t: DataFrame, err_day: DataFrame, resolution_fill: float = 0.0) -> DataFrame:
    """Left join on (device_id, date) with the executed fills."""
    j = t.join(err_day, ["device_id", "date"], "left")
    fills = {f"error_{s.lower()}_count": 0 for s in VALID_SEVERITIES}
    fills.update({"unique_error_types": 0, "error_resolution_rate": resolution_fill, "top_error_code": "NONE"})
    return j.fillna(fills)


# ---------------------------------------------------------------- A5 / J2
MAINT_COLS = ["total_maintenance_count", "corrective_count", "emergency_count", "avg_resolution_hours",
              "sla_compliance_rate", "total_cost_gbp", "parts_replaced_count"]


def maintenance_rollup(m: DataFrame) -> DataFrame:
    mt = F.col("maintenance_type")
    return m.groupBy("device_id").agg(
        F.count("date").alias("total_maintenance_count"),
        F.count_if(mt == "Corrective").alias("corrective_count"),
        F.count_if(mt == "Emergency").alias("emergency_count"),
        F.avg("actual_resolution_hours").alias("avg_resolution_hours"),
        F.avg(F.col("sla_met").cast("double")).alias("sla_compliance_rate"),
        F.sum("cost_gbp").alias("total_cost_gbp"),
        F.sum("parts_replaced").alias("parts_replaced_count"),
    )


def join_maintenance_features(t: DataFrame, maint_agg: DataFrame) -> DataFrame:
    # per-device table: size grows with the fleet, so no blind broadcast hint;
    # AQE switches to a broadcast join at runtime when the measured size is small.
    j = t.join(maint_agg, "device_id", "left")
    return j.fillna({c: 0 for c in MAINT_COLS})


# ---------------------------------------------------------------- J3 / P11
DEVICE_COLS = ["station", "gate_type", "manufacturer", "firmware_version", "age_days",
               "warranty_remaining_days", "failure_prone"]


def device_flag_exprs() -> list[Column]:
    return [
        as_int_flag(F.col("age_days") > 1000).alias("is_old_device"),
        as_int_flag(F.col("firmware_version") == BETA_FIRMWARE).alias("is_beta_firmware"),
        as_int_flag(F.col("warranty_remaining_days") > 0).alias("is_under_warranty"),
        as_int_flag(F.col("station").isin(HIGH_TRAFFIC_STATIONS)).alias("is_high_traffic_station"),
    ]


def join_device_features(t: DataFrame, devices: DataFrame) -> DataFrame:
    j = t.join(devices.select("device_id", *DEVICE_COLS), "device_id", "left")
    return j.select("*", *device_flag_exprs())


# ---------------------------------------------------------------- gold
def gold_features(telemetry: DataFrame, errors: DataFrame, maintenance: DataFrame,
                  devices: DataFrame, resolution_fill: float = 0.0) -> DataFrame:
    """The 66-column gold table, one row per telemetry row.

    Joins first (device-day, then device), windows last: the final hash
    partitioning on ``device_id`` from the device joins is reused by the
    windows, so the window block adds a sort but no exchange.
    """
    base = join_error_features(telemetry, error_day_features(errors), resolution_fill)
    base = join_maintenance_features(base, maintenance_rollup(maintenance))
    base = join_device_features(base, devices)
    return base.select(
        "*",
        *rolling_exprs(),
        *delta_exprs(),
        *cumulative_exprs(),
        health_score(rounded=True).alias("health_score"),
        failure_next_3d_as_coded().alias("failure_next_3d"),
        lookahead_flag(F.col("failure_today") == 1).alias("failure_within_3d"),
    )


# ---------------------------------------------------------------- B7 / B8 / B9
def calendar_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    d = F.col(date_col)
    month = F.month(d)
    season = (F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring")
              .when(month.isin(6, 7, 8), "Summer").otherwise("Autumn"))
    dow = F.dayofweek(d)  # 1 = Sunday
    return df.select(
        "*",
        as_int_flag(dow.isin(1, 7)).alias("is_weekend"),
        dow.alias("day_of_week"),
        month.alias("month"),
        F.quarter(d).alias("quarter"),
        season.alias("season"),
    )


def maintenance_window_features(m: DataFrame, days: int = 30) -> DataFrame:
    """Per maintenance row: cost over the trailing ``days`` days (inclusive) and running count.

    Windows over a device run over its days only, at most as many as the calendar has; rows are ranked within
    a device and day, so a device with many jobs is spread over tasks by day."""
    w = Window.partitionBy("device_id").orderBy(day_number("date"))
    daily = m.groupBy("device_id", "date").agg(F.sum("cost_gbp").alias("_cost"), F.count(F.lit(1)).alias("_jobs")).select(
        F.col("device_id").alias("_device"), F.col("date").alias("_date"),
        F.sum("_cost").over(w.rangeBetween(-(days - 1), 0)).alias(f"cost_{days}d"),
        (F.sum("_jobs").over(w.rangeBetween(Window.unboundedPreceding, 0)) - F.col("_jobs")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("device_id", "date").orderBy("maintenance_id"))
    ranked = m.withColumn("_rank", rank)
    joined = ranked.join(daily, ranked["device_id"].eqNullSafe(daily["_device"]) & ranked["date"].eqNullSafe(daily["_date"]), "left")
    return joined.select(*m.columns, f"cost_{days}d", (F.col("_before") + F.col("_rank")).alias("running_maintenance_count"))
