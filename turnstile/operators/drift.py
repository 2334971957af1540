"""Data drift between a reference and a current period.

Two-sample Kolmogorov-Smirnov per numeric feature: values are unpivoted and
pre-aggregated to (feature, value) counts per period, the empirical CDFs are
running sums in value order computed with bucketed prefix sums (no window
spans a whole feature), and D = max |F_ref - F_cur| is a grouped max.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.stats import bucketed_prefix_sums, ks_pvalue_col

# Monitored features and thresholds.
MONITOR_FEATURES = [
    "signal_strength_dbm", "temperature_c", "response_time_ms",
    "network_latency_ms", "power_voltage", "memory_usage_pct",
    "cpu_usage_pct", "error_count", "tap_success_rate",
    "uptime_hours", "health_score", "daily_taps",
    "signal_strength_dbm_7d_mean", "error_count_7d_mean",
    "cumulative_errors",
]
DRIFT_THRESHOLD = 0.30
P_THRESHOLD = 0.05
RETRAIN_INTERVAL_DAYS = 15


# ---------------------------------------------------------------- D1
def _dates(df: DataFrame, date_col: str) -> list:
    # distinct dates: one per day of history (bounded by the horizon)
    return [r[0] for r in df.select(date_col).distinct().orderBy(date_col).collect()]


def split_at_nth_date(df: DataFrame, n: int = 20, date_col: str = "date") -> DataFrame:
    """reference = dates before the (n+1)-th distinct date, current = from it on."""
    dates = _dates(df, date_col)
    if len(dates) <= n:
        raise ValueError(f"need more than {n} distinct dates, got {len(dates)}")
    split = dates[n]
    return df.withColumn("period", F.when(F.col(date_col) < F.lit(split), "reference").otherwise("current"))


def split_at_share(df: DataFrame, share: float = 0.7, min_dates: int = 10, date_col: str = "date") -> DataFrame | None:
    """Daily variant: split at ``share`` of the sorted dates; None when too few dates."""
    dates = _dates(df, date_col)
    if len(dates) < min_dates:
        return None
    split = dates[int(len(dates) * share)]
    return df.withColumn("period", F.when(F.col(date_col) < F.lit(split), "reference").otherwise("current"))


# ---------------------------------------------------------------- D2
def unpivot_periods(tagged: DataFrame, features: list[str]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    return tagged.select("period", F.explode(F.array(*rows)).alias("r")).select("period", "r.*") \
        .where(F.col("value").isNotNull())


def ks_drift(tagged: DataFrame, features: list[str] | None = None, p_threshold: float = P_THRESHOLD) -> DataFrame:
    """Per feature: KS statistic, asymptotic p-value, drifted flag (p < threshold)."""
    features = [c for c in (features or MONITOR_FEATURES) if c in tagged.columns]
    long = unpivot_periods(tagged, features)
    counts = long.groupBy("feature", "value").agg(
        F.count_if(F.col("period") == "reference").alias("n_ref"),
        F.count_if(F.col("period") == "current").alias("n_cur"))
    cum = bucketed_prefix_sums(counts, ["feature"], "value", ["n_ref", "n_cur"], inclusive=True)
    tot = cum.groupBy("feature").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))  # of the written counts
    j = cum.join(F.broadcast(tot), "feature")  # one row a feature
    gap = F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur"))
    d = j.groupBy("feature", "tot_ref", "tot_cur").agg(F.max(gap).alias("ks_statistic"))
    p = ks_pvalue_col(F.col("ks_statistic"), F.col("tot_ref").cast("double"), F.col("tot_cur").cast("double"))
    return d.select("feature", F.col("tot_ref").alias("n_reference"), F.col("tot_cur").alias("n_current"),
                    "ks_statistic", p.alias("p_value"), F.lit("ks").alias("method"),
                    (p < p_threshold).alias("drifted"))


# ---------------------------------------------------------------- D3
def _chi2_sf(x: float, dof: int) -> float:
    """Upper tail of chi-square with integer dof (closed-form series)."""
    if x is None or dof is None or dof <= 0 or x != x:
        return float("nan")
    if x <= 0:
        return 1.0
    if dof % 2 == 0:
        term = s = math.exp(-x / 2)
        for k in range(1, dof // 2):
            term *= (x / 2) / k
            s += term
        return min(1.0, s)
    # odd dof: Q = erfc(sqrt(x/2)) + exp(-x/2) * sum_{k=1}^{(dof-1)/2} (x/2)^(k-1/2) / Gamma(k+1/2)
    s = math.erfc(math.sqrt(x / 2))
    for k in range(1, (dof - 1) // 2 + 1):
        s += math.exp(-x / 2 + (k - 0.5) * math.log(x / 2) - math.lgamma(k + 0.5))
    return min(1.0, s)


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_chi2_sf(float(a), int(b)) for a, b in zip(x, dof)])


def chi_square_drift(tagged: DataFrame, features: list[str], p_threshold: float = P_THRESHOLD) -> DataFrame:
    """Per categorical feature: Pearson chi-square of category x period counts."""
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in features]
    long = tagged.select("period", F.explode(F.array(*rows)).alias("r")).select("period", "r.*")
    ct = long.groupBy("feature", "category").agg(
        F.count_if(F.col("period") == "reference").alias("o_ref"),
        F.count_if(F.col("period") == "current").alias("o_cur"))
    w = Window.partitionBy("feature")  # categories of one feature: a short code list
    n_ref, n_cur = F.sum("o_ref").over(w), F.sum("o_cur").over(w)
    row = F.col("o_ref") + F.col("o_cur")
    n = n_ref + n_cur
    e_ref, e_cur = row * n_ref / n, row * n_cur / n
    cell = (F.when(e_ref > 0, F.pow(F.col("o_ref") - e_ref, 2) / e_ref).otherwise(0)
            + F.when(e_cur > 0, F.pow(F.col("o_cur") - e_cur, 2) / e_cur).otherwise(0))
    chi = ct.select("feature", cell.alias("cell")).groupBy("feature").agg(
        F.sum("cell").alias("chi2"), (F.count(F.lit(1)) - 1).cast("int").alias("dof"))
    p = chi2_pvalue(F.col("chi2"), F.col("dof"))
    return chi.select("feature", "chi2", "dof", p.alias("p_value"), F.lit("chi_square").alias("method"),
                      (p < p_threshold).alias("drifted"))


# ---------------------------------------------------------------- D4 / D5
def drift_share(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("n_features"), F.count_if("drifted").alias("n_drifted"),
                       F.avg(F.col("drifted").cast("double")).alias("drift_share"))


def retrain_decision(share: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    s = F.col("drift_share")
    retrain = s > threshold
    pct = F.format_number(s * 100, 1)
    reason = F.concat(F.lit("Drift share "), pct, F.lit("% "),
                      F.when(retrain, "exceeds").otherwise("within"), F.lit(f" {threshold * 100:.0f}% threshold"))
    return share.select("drift_share", F.lit(threshold).alias("threshold"), retrain.alias("should_retrain"),
                        reason.alias("reason"))


# ---------------------------------------------------------------- D6
def data_summary(tagged: DataFrame, features: list[str]) -> DataFrame:
    """Per period and feature: rows, missing, distinct, mean, std, min, max."""
    long = tagged.select("period", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])).alias("r")) \
        .select("period", "r.*")
    return long.groupBy("period", "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.count_distinct("value").alias("distinct"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def duplicate_summary(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Per period: rows, distinct keys, duplicate rows."""
    g = tagged.groupBy("period", *keys).agg(F.count(F.lit(1)).alias("n"))  # combined map-side, then one row a key
    return g.groupBy("period").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                                   (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


# ---------------------------------------------------------------- D7 / D8
def retrain_rule(state: DataFrame, interval_days: int = RETRAIN_INTERVAL_DAYS) -> DataFrame:
    """state: current_date, last_retrain_date (nullable), force, drift_retrain, drift_share."""
    days = F.datediff("current_date", "last_retrain_date")
    retrain = (F.col("force") | F.col("last_retrain_date").isNull() | (days >= interval_days)
               | F.coalesce(F.col("drift_retrain"), F.lit(False)))
    reason = (F.when(F.col("force"), F.lit("Forced retraining"))
              .when(F.col("last_retrain_date").isNull(), F.lit("First training (no previous record)"))
              .when(days >= interval_days, F.concat(F.lit("Scheduled retrain ("), days.cast("string"),
                                                    F.lit(" days since last)")))
              .when(F.coalesce(F.col("drift_retrain"), F.lit(False)),
                    F.concat(F.lit("Drift detected ("), F.format_number(F.col("drift_share") * 100, 1),
                             F.lit(f"% > {DRIFT_THRESHOLD * 100:.0f}%)")))
              .otherwise(F.concat(F.lit("Not due ("), days.cast("string"), F.lit(f"/{interval_days} days, no drift)"))))
    return state.select("*", retrain.alias("retrain"), reason.alias("reason"))


def decision_matrix(df: DataFrame, share_col: str = "drift_share", auc_col: str = "auc") -> DataFrame:
    """Action by drift share and AUC.  A share of exactly 0.3 is minor drift and an AUC of exactly 0.85 good;
    without drift an AUC of 0.85 to 0.90 is watched."""
    s, a = F.col(share_col), F.col(auc_col)
    action = (F.when(s > 0.5, "Emergency retrain + alert team")
              .when((s > 0.3) & (a < 0.85), "Urgent retrain + root cause")
              .when(s > 0.3, "Retrain (proactive)")
              .when(a < 0.85, "Investigate features, retrain")
              .when(s >= 0.1, "Monitor, retrain next month")
              .when(a > 0.90, "Do nothing")
              .otherwise("Monitor"))
    return df.select("*", action.alias("action"))
