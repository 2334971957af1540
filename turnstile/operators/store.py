"""Feature store: named feature-set projections (S11), column profile (A11),
feature catalog (B10) and source profile (B13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feature-set definitions (names must equal the reference's).
FEATURE_SETS = {
    "ps1_failure_prediction": {
        "numeric": [
            "signal_strength_dbm", "temperature_c", "response_time_ms",
            "network_latency_ms", "power_voltage", "memory_usage_pct",
            "cpu_usage_pct", "error_count", "reboot_count", "uptime_hours",
            "daily_taps", "tap_success_rate", "health_score",
            "signal_strength_dbm_7d_mean", "temperature_c_7d_mean",
            "error_count_7d_mean", "response_time_ms_7d_mean",
            "signal_strength_dbm_7d_std", "error_count_7d_std",
            "signal_strength_dbm_delta", "temperature_c_delta",
            "error_count_delta", "cumulative_errors", "cumulative_reboots",
            "days_since_last_failure", "age_days", "total_maintenance_count",
            "corrective_count", "emergency_count",
        ],
        "categorical": [
            "manufacturer", "firmware_version", "gate_type",
            "is_old_device", "is_beta_firmware", "is_under_warranty",
            "is_high_traffic_station",
        ],
        "target": "failure_next_3d",
    },
    "ps4_anomaly_detection": {
        "numeric": [
            "signal_strength_dbm", "temperature_c", "response_time_ms",
            "network_latency_ms", "power_voltage", "memory_usage_pct",
            "cpu_usage_pct", "error_count", "tap_success_rate",
            "uptime_hours", "health_score",
        ],
    },
    "ps5_sla_risk": {
        "numeric": [
            "age_days", "total_maintenance_count", "corrective_count",
            "emergency_count", "avg_resolution_hours", "sla_compliance_rate",
            "total_cost_gbp", "health_score", "cumulative_errors",
            "cumulative_reboots", "error_count_7d_mean",
        ],
        "categorical": ["manufacturer", "firmware_version", "is_old_device"],
    },
}

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)


def feature_set(gold: DataFrame, name: str) -> DataFrame:
    """Keys + numeric + categorical + target, existing columns only."""
    cfg = FEATURE_SETS[name]
    wanted = ["device_id", "date"] + cfg.get("numeric", []) + cfg.get("categorical", [])
    if cfg.get("target"):
        wanted.append(cfg["target"])
    have = set(gold.columns)
    return gold.select(*[c for c in wanted if c in have])


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list, k: int, salt_col: str,
                    salts: int = 64) -> DataFrame:
    """Exact top-k rows per group without putting a whole group in one task.

    Rows are first ranked inside (group, hash(salt_col) % salts) sub-groups;
    only the k best of each survive, then a final rank runs over at most
    k * salts rows per group.  Ties are broken by ``order_cols`` (include a
    unique column for determinism).
    """
    s = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts))
    w1 = Window.partitionBy(*group_cols, s).orderBy(*order_cols)
    pre = df.withColumn("_rk1", F.row_number().over(w1)).where(F.col("_rk1") <= k).drop("_rk1")
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def profile_numeric(df: DataFrame) -> DataFrame:
    """A11 numeric part: one aggregation, unpivoted to one row per column."""
    num = [f for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    aggs = []
    for f in num:
        x = F.col(f.name).cast("double")
        aggs += [F.min(x).alias(f"{f.name}__min"), F.max(x).alias(f"{f.name}__max"),
                 F.avg(x).alias(f"{f.name}__mean"), F.avg(F.col(f.name).isNull().cast("double")).alias(f"{f.name}__null_pct")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"{f.name}__min").alias("min"), F.col(f"{f.name}__max").alias("max"),
                     F.col(f"{f.name}__mean").alias("mean"), F.col(f"{f.name}__null_pct").alias("null_pct"))
            for f in num]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_strings(df: DataFrame, top: int = 5) -> DataFrame:
    """A11 string part: distinct count and top-``top`` values per string column.

    Unpivot to (column, value), count per value (map-side combined), then an
    exact salted top-k; distinct counts come from the same value-count table.
    """
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strs:
        return df.sparkSession.createDataFrame([], "column string, unique_values bigint, top_values array<struct<value:string,count:bigint>>")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in strs])).alias("s")) \
        .select("s.column", "s.value").where(F.col("value").isNotNull())
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    distinct = vc.groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
    topk = top_k_per_group(vc, ["column"], [F.col("count").desc(), F.col("value")], top, "value")
    tops = topk.groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "count"))),
                    lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"))).alias("top_values"))
    return distinct.join(tops, "column", "left")


def table_profile(df: DataFrame, date_col: str = "date", key: str = "device_id") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.lit(len(df.columns)).alias("total_features"),
        F.min(date_col).alias("date_start"),
        F.max(date_col).alias("date_end"),
        F.count_distinct(key).alias("devices"),
    )


def feature_catalog(gold: DataFrame) -> DataFrame:
    """One row per gold column: name, type, source, window, null rule, feature sets using it."""
    rows = []
    for f in gold.schema.fields:
        n = f.name
        if "_7d_" in n:
            src, win = "telemetry", "7 rows"
        elif n.endswith("_delta"):
            src, win = "telemetry", "1 row lag"
        elif n.startswith("cumulative_") or n in ("failure_cumsum", "days_since_last_failure"):
            src, win = "telemetry", "running"
        elif n.startswith("error_") and n != "error_count" or n in ("top_error_code", "unique_error_types"):
            src, win = "error_logs", "device-day"
        elif n in ("total_maintenance_count", "corrective_count", "emergency_count", "avg_resolution_hours",
                   "sla_compliance_rate", "total_cost_gbp", "parts_replaced_count"):
            src, win = "maintenance", "all history"
        elif n in ("station", "gate_type", "manufacturer", "firmware_version", "age_days",
                   "warranty_remaining_days", "failure_prone") or n.startswith("is_"):
            src, win = "devices", "static"
        else:
            src, win = "telemetry", "day"
        null_rule = "NONE" if n == "top_error_code" else ("zero" if src in ("error_logs", "maintenance") else "median")
        sets = [s for s, cfg in FEATURE_SETS.items()
                if n in cfg.get("numeric", []) + cfg.get("categorical", []) + [cfg.get("target")]]
        rows.append((n, f.dataType.simpleString(), src, win, null_rule, sets))
    return gold.sparkSession.createDataFrame(
        rows, "feature string, dtype string, source string, window string, null_rule string, feature_sets array<string>")


def source_profile(df: DataFrame, keys: list[str], date_col: str | None = None) -> DataFrame:
    """Rows, null rate over all cells, duplicate-key rate, date range."""
    nulls = None
    for c in df.columns:
        e = F.col(c).isNull().cast("int")
        nulls = e if nulls is None else nulls + e
    aggs = [F.count(F.lit(1)).alias("rows"),
            (F.sum(nulls) / (F.count(F.lit(1)) * len(df.columns))).alias("null_rate"),
            (F.lit(1.0) - F.count_distinct(*[F.col(k) for k in keys]) / F.count(F.lit(1))).alias("duplicate_rate")]
    if date_col:
        aggs += [F.min(date_col).alias("date_start"), F.max(date_col).alias("date_end")]
    return df.agg(*aggs)
