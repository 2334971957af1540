"""Batch scoring rules (P17-P26, A19-A24, A28): every device scored in one
DataFrame pass, never a per-device loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.exprs import (
    IMPACT_RANK,
    NO_CAUSE,
    ROOT_CAUSE_RULES,
    SLA_RULE_TIERS,
    failure_tier_batch,
    failure_tier_serving,
    np_round,
)


def latest_per_device(df: DataFrame, key: str = "device_id", order: str = "date") -> DataFrame:
    """The newest row of each device (max_by inside a map-side combined aggregation)."""
    rest = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


# ---------------------------------------------------------------- P19 / M32 breach
def sla_rule_score(df: DataFrame) -> DataFrame:
    """Rule SLA score 0-100, RUL, tier, action and breach probability."""
    health = F.coalesce(F.col("health_score"), F.lit(50.0))
    errs = F.coalesce(F.col("cumulative_errors"), F.lit(0))
    age = F.coalesce(F.col("age_days"), F.lit(0))
    maint = F.coalesce(F.col("total_maintenance_count"), F.lit(0))
    emerg = F.coalesce(F.col("emergency_count"), F.lit(0))
    raw = ((1 - health / 100) * 35 + F.least(errs / 50, F.lit(1.0)) * 25 + F.least(age / 1500, F.lit(1.0)) * 20
           + F.least(maint / 10, F.lit(1.0)) * 10 + F.when(emerg > 0, 10).otherwise(0))
    s = F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))
    rul = F.greatest(F.lit(1), F.floor(90 * (1 - s / 100)).cast("int"))
    tier = None
    action = None
    for lo, t, a in SLA_RULE_TIERS:
        tier = F.when(s >= lo, t) if tier is None else tier.when(s >= lo, t)
        action = F.when(s >= lo, a) if action is None else action.when(s >= lo, a)
    breach = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(0.1) * (rul - 15)))
    return df.select("*", np_round(s, 1).alias("sla_risk_score"), rul.alias("rul_estimate_days"),
                     tier.alias("risk_tier"), action.alias("recommended_action"),
                     np_round(breach, 4).alias("sla_breach_probability"))


# ---------------------------------------------------------------- P17 / P18
def tiers(df: DataFrame, prob_col: str) -> DataFrame:
    serving = failure_tier_serving(prob_col)
    return df.select("*", failure_tier_batch(prob_col).alias("tier_batch"),
                     serving["tier"].alias("tier_serving"), serving["confidence"].alias("tier_confidence"),
                     serving["action"].alias("tier_action"), (F.col(prob_col) >= 0.5).cast("int").alias("prediction"))


# ---------------------------------------------------------------- P20
def default_model_features(df: DataFrame) -> DataFrame:
    """Fill model inputs a scoring request may lack (defaults as served)."""
    fills = {
        "signal_strength_dbm_7d_mean": F.col("signal_strength_dbm"),
        "temperature_c_7d_mean": F.col("temperature_c"),
        "error_count_7d_mean": F.col("error_count").cast("double"),
        "response_time_ms_7d_mean": F.col("response_time_ms"),
        "signal_strength_dbm_7d_std": F.lit(3.0),
        "error_count_7d_std": F.lit(1.0),
        "signal_strength_dbm_delta": F.lit(0.0),
        "temperature_c_delta": F.lit(0.0),
        "error_count_delta": F.lit(0.0),
        "days_since_last_failure": F.lit(10),
        "manufacturer": F.lit(0),
        "firmware_version": F.lit(0),
        "gate_type": F.lit(0),
        "is_old_device": (F.col("age_days") > 1000).cast("int"),
        "is_beta_firmware": F.lit(0),
        "is_under_warranty": (F.col("age_days") < 730).cast("int"),
        "is_high_traffic_station": F.lit(0),
    }
    have = set(df.columns)
    out = [F.col(c) for c in df.columns]
    for c, e in fills.items():
        if c in have:
            out[df.columns.index(c)] = F.coalesce(F.col(c), e).alias(c)
        else:
            out.append(e.alias(c))
    return df.select(*out)


# ---------------------------------------------------------------- P21
# Served request bounds (ge, le); None = unbounded on that side.
REQUEST_BOUNDS = {
    "signal_strength_dbm": (0, 100), "temperature_c": (-10, 80), "response_time_ms": (10, None),
    "network_latency_ms": (1, None), "power_voltage": (2.0, 6.0), "memory_usage_pct": (0, 100),
    "cpu_usage_pct": (0, 100), "error_count": (0, None), "reboot_count": (0, None), "uptime_hours": (0, 24),
    "daily_taps": (0, None), "tap_success_rate": (0, 1.0), "health_score": (0, 100), "age_days": (0, None),
    "cumulative_errors": (0, None), "cumulative_reboots": (0, None), "total_maintenance_count": (0, None),
    "corrective_count": (0, None), "emergency_count": (0, None),
}


def _in_bounds(c: str, lo, hi) -> Column:
    x = F.col(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= lo)
    if hi is not None:
        cond = cond & (x <= hi)
    return cond


def validate_requests(df: DataFrame, bounds=REQUEST_BOUNDS) -> tuple[DataFrame, DataFrame]:
    """Split scoring rows into (valid, rejected with the failed fields)."""
    checks = [F.when(~F.coalesce(_in_bounds(c, lo, hi), F.lit(True)), F.lit(c))
              for c, (lo, hi) in bounds.items() if c in df.columns]
    t = df.withColumn("_bad", F.filter(F.array(*checks), lambda x: x.isNotNull()))
    return (t.where(F.size("_bad") == 0).drop("_bad"),
            t.where(F.size("_bad") > 0).withColumnRenamed("_bad", "invalid_fields"))


# ---------------------------------------------------------------- P22
def error_indicators(df: DataFrame) -> DataFrame:
    age1 = F.greatest(F.col("age_days"), F.lit(1))
    ec = F.col("error_count")
    return df.select(
        "*",
        np_round(F.col("cumulative_errors") / age1, 4).alias("error_rate_per_day"),
        F.when(ec >= 5, "HIGH").when(ec >= 2, "MEDIUM").otherwise("LOW").alias("error_severity"),
        np_round(F.col("cumulative_reboots") / age1 * 30, 2).alias("reboot_frequency"),
        ((ec >= 3) & (F.col("emergency_count") >= 1)).alias("likely_escalation"),
    )


# ---------------------------------------------------------------- P23
def _cmp(c: str, op: str, v) -> Column:
    x = F.col(c)
    return {"<": x < v, ">": x > v, ">=": x >= v}[op]


def root_cause(df: DataFrame) -> DataFrame:
    """Threshold rules -> list of {factor, value, impact} sorted HIGH..LOW (stable),
    count, and primary cause = first firing rule in rule order."""
    hits = F.filter(F.array(*[
        F.when(_cmp(c, op, v), F.struct(F.lit(name).alias("factor"), F.col(c).cast("double").alias("value"),
                                         F.lit(imp).alias("impact"), F.lit(IMPACT_RANK[imp]).alias("rank")))
        for name, c, op, v, imp in ROOT_CAUSE_RULES]), lambda x: x.isNotNull())
    ordered = F.array_sort(hits, lambda a, b: a["rank"] - b["rank"])
    return df.select(
        "*",
        F.transform(ordered, lambda x: F.struct(x["factor"].alias("factor"), x["value"].alias("value"),
                                                x["impact"].alias("impact"))).alias("risk_factors"),
        F.size(hits).alias("total_risk_factors"),
        F.coalesce(F.get(hits, 0)["factor"], F.lit(NO_CAUSE)).alias("primary_cause"),
    )


# ---------------------------------------------------------------- P26
ANOMALY_FEATURES = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms",
                    "power_voltage", "memory_usage_pct", "cpu_usage_pct", "error_count", "tap_success_rate",
                    "uptime_hours", "health_score"]


def anomaly_feature_map(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    m = F.create_map(*[x for c in ANOMALY_FEATURES for x in (F.lit(c), np_round(F.col(c).cast("double"), 2))])
    return df.select("*", F.when(F.col(flag), m).otherwise(
        F.create_map().cast("map<string,double>")).alias("anomalous_features"))


# ---------------------------------------------------------------- A19 / A20 / A22 / A24 / A28
def fleet_summary(scored: DataFrame) -> DataFrame:
    """Batch summary of the scored fleet: failure-tier counts (if ``failure_risk_tier`` is there),
    errors, devices with risk factors, anomalies and normals (if ``is_anomaly`` is there), SLA tiers,
    rounded means."""
    has = set(scored.columns)
    tier = [t for _, t, _ in SLA_RULE_TIERS]
    return scored.agg(
        F.count(F.lit(1)).alias("devices"),
        *[F.count_if(F.col("failure_risk_tier") == t).alias(f"failure_{t.lower()}") for t in tier if "failure_risk_tier" in has],
        F.count_if(F.col("error_count") >= 3).alias("devices_errors_ge3"),
        F.count_if(F.col("error_count") >= 5).alias("devices_errors_ge5"),
        np_round(F.avg("error_count"), 2).alias("mean_error_count"),
        *([F.count_if(F.col("total_risk_factors") > 0).alias("devices_with_risk_factors")] if "total_risk_factors" in has else []),
        *([F.count_if("is_anomaly").alias("anomalies"), F.count_if(~F.col("is_anomaly")).alias("normal")] if "is_anomaly" in has else []),
        *[F.count_if(F.col("risk_tier") == t).alias(f"tier_{t.lower()}") for t in tier],
        np_round(F.avg("rul_estimate_days"), 1).alias("mean_rul"),
    )


def top_fleet_cause(scored: DataFrame) -> DataFrame:
    """Most frequent risk factor over all factors of all devices, with its device count
    (ties by name); ("None", 0) when no device has one.  Needs root_cause()."""
    c = scored.select(F.explode("risk_factors.factor").alias("cause")).groupBy("cause").agg(
        F.count(F.lit(1)).alias("affected_devices"))
    best = c.agg(F.min_by(F.struct("cause", "affected_devices"), F.struct(-F.col("affected_devices"), F.col("cause"))).alias("b"))
    return best.select(F.coalesce("b.cause", F.lit("None")).alias("cause"),
                       F.coalesce("b.affected_devices", F.lit(0)).alias("affected_devices"))


def rul_histogram(df: DataFrame, col: str = "rul_estimate_days") -> DataFrame:
    x = F.col(col)
    b = (F.when(x <= 7, "<=7").when(x <= 14, "8-14").when(x <= 30, "15-30").when(x <= 60, "31-60")
         .otherwise(">60"))
    return df.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("devices"))


def cumulative_histogram(df: DataFrame, col: str, bounds: list[float]) -> DataFrame:
    """Prometheus-style cumulative buckets: count of values <= le for each bound (+Inf)."""
    x = F.col(col)
    aggs = [F.count_if(x <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    one = df.agg(*aggs, F.count(x).alias("le_inf"), F.sum(x).alias("sum"))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("count")))
    return one.select(F.explode(F.array(*rows)).alias("r"), "sum").select("r.le", "r.count", "sum")


# Bucket bounds of the served distributions.
HISTOGRAM_BOUNDS = {
    "failure_probability": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "anomaly_score": [-0.5, -0.3, -0.2, -0.1, 0, 0.1, 0.2, 0.3, 0.5],
    "sla_risk_score": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100],
    "rul_estimate_days": [7, 14, 21, 30, 45, 60, 90],
}


def served_histograms(scored: DataFrame, bounds: dict[str, list] = HISTOGRAM_BOUNDS) -> DataFrame:
    """All distributions in one pass: (metric, le, count), cumulative, with +Inf."""
    have = {c: b for c, b in bounds.items() if c in scored.columns}
    one = scored.agg(*[F.count_if(F.col(c) <= x).alias(f"{c}_{i}") for c, b in have.items() for i, x in enumerate(b)],
                     *[F.count(c).alias(f"{c}_inf") for c in have])
    rows = [F.struct(F.lit(c).alias("metric"), F.lit(str(x)).alias("le"), F.col(f"{c}_{i}").alias("count"))
            for c, b in have.items() for i, x in enumerate(b)]
    rows += [F.struct(F.lit(c).alias("metric"), F.lit("+Inf").alias("le"), F.col(f"{c}_inf").alias("count")) for c in have]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def served_counters(scored: DataFrame, tier_cols: dict[str, str]) -> DataFrame:
    """Predictions by (problem statement, tier): ``tier_cols`` names the tier column of each."""
    rows = F.array(*[F.struct(F.lit(ps).alias("problem_statement"), F.col(c).alias("risk_tier")) for ps, c in tier_cols.items()])
    return (scored.select(F.explode(rows).alias("r")).where("r.risk_tier IS NOT NULL")
                  .groupBy("r.problem_statement", "r.risk_tier").agg(F.count(F.lit(1)).alias("predictions")))


def dashboard_values(blocks: list[tuple]) -> DataFrame:
    """The dashboard document in long form, one row a value (block, item, metric, value).

    ``blocks`` lists (block, summary, item column or None, metric columns); every summary is a table
    whose size doesn't depend on the fleet (one row, or a row a tier, feature or check)."""
    out = None
    for block, df, item, metrics in blocks:
        values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        rows = df.select(F.lit(block).alias("block"), (F.col(item).cast("string") if item else F.lit("")).alias("item"),
                         F.explode(values).alias("v")).select("block", "item", "v.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def dashboard_document(values: DataFrame) -> DataFrame:
    """The dashboard as one row with one JSON object: block -> item -> metric -> value, all in order of name.

    A block without items has the one item ``all``; values have four decimals; NULL and what is no number is ``null``."""
    real = F.when(~F.isnan("value") & (F.abs("value") != float("inf")), F.round("value", 4)).cast("decimal(20,4)")
    rows = values.select("block", F.when(F.col("item") == "", "all").otherwise(F.col("item")).alias("item"), "metric", real.alias("value"))

    metrics = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))
    items = rows.groupBy("block", "item").agg(F.to_json(metrics).alias("content"))

    def joined(df, keys, name):
        """The rows of each group as one JSON object; maps can't be compared, so contents are sorted as text."""
        pairs = F.array_sort(F.collect_list(F.struct(F.to_json(F.array(name)).alias("key"), "content")))
        text = F.transform(pairs, lambda p: F.concat(F.regexp_replace(p["key"], r"^\[|\]$", ""), F.lit(":"), p["content"]))
        return df.groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias("content"))

    return joined(joined(items, ["block"], "item"), [], "block").select(F.col("content").alias("document"))
