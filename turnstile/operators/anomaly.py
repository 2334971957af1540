"""Anomalies: isolation forest (M22, A25), SPC control charts
and anomaly summaries (A8-A10).

Isolation forest at scale: each tree is grown in ``applyInPandas`` from its own
sample of min(256, n) rows: a row is offered to a tree when a hash of its key and the
tree's number is below a rate, and the tree keeps the rows with the smallest
hashes.  So a tree's sample depends on the rows alone, neither on their number nor
on their partitions.  The forest (trees x nodes, bounded) is collected and shipped
to the executors inside a vectorised ``mapInPandas`` scorer.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.stats import exact_quantiles
from turnstile.session import materialize

SPC_FEATURES = ["signal_strength_dbm", "temperature_c", "response_time_ms", "error_count",
                "tap_success_rate", "health_score"]
ANOMALY_FEATURES = ["signal_strength_dbm", "temperature_c", "response_time_ms", "network_latency_ms",
                    "power_voltage", "memory_usage_pct", "cpu_usage_pct", "error_count", "tap_success_rate",
                    "uptime_hours", "health_score"]


# ---------------------------------------------------------------- P15
def zscore(df: DataFrame, cols: list[str], sample: bool = False) -> DataFrame:
    std = F.stddev_samp if sample else F.stddev_pop
    st = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}_m"), std(c).alias(f"{c}_s"))]).first()
    out = []
    for c in df.columns:
        if c in cols:
            m, s = st[f"{c}_m"], st[f"{c}_s"]
            out.append(((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ---------------------------------------------------------------- M22
def _c(n: float) -> float:
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Array-encoded isolation tree: feature, threshold, left, right, size (leaf: feature = -1)."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(rows, depth):
        i = len(feat)
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(len(rows))
        if depth >= max_depth or len(rows) <= 1:
            return i
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        ok = np.where(hi > lo)[0]
        if len(ok) == 0:
            return i
        f = int(rng.choice(ok))
        t = float(rng.uniform(lo[f], hi[f]))
        mask = rows[:, f] < t
        feat[i] = f
        thr[i] = t
        left[i] = node(rows[mask], depth + 1)
        right[i] = node(rows[~mask], depth + 1)
        return i

    node(x, 0)
    return np.array(feat), np.array(thr), np.array(left), np.array(right), np.array(size, dtype=float)


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, size = tree
    idx = np.zeros(len(x), dtype=int)
    depth = np.zeros(len(x))
    active = feat[idx] >= 0
    while active.any():
        f = feat[idx[active]]
        go_left = x[active, f] < thr[idx[active]]
        nxt = np.where(go_left, left[idx[active]], right[idx[active]])
        idx[active] = nxt
        depth[active] += 1
        active = feat[idx] >= 0
    return depth + _leaf_c(size)[idx]


def _leaf_c(size: np.ndarray) -> np.ndarray:
    """c(n) for every node size (vectorised): average unsuccessful-search path length."""
    n = np.asarray(size, dtype=float)
    out = np.zeros_like(n)
    big = n > 1
    out[big] = 2.0 * (np.log(n[big] - 1) + 0.5772156649015329) - 2.0 * (n[big] - 1) / n[big]
    return out


def fit_isolation_forest(df: DataFrame, cols: list[str], n_trees: int = 200, sample_size: int = 256,
                         seed: int = 42, keys: list[str] | None = None) -> dict:
    """Grow ``n_trees`` trees, each from its own sample of min(``sample_size``, n) rows.

    ``keys`` tell rows apart: by default device_id and date where they are there, else all columns."""
    keys = keys or [c for c in ("device_id", "date") if c in df.columns] or df.columns
    n = df.count()
    psi = min(sample_size, n)
    # about 2 psi rows are offered to each tree (fewer than psi: less than once in 10^20 forests)
    limit = min(2**63 - 1, (2**63 - 1) * 2 * psi // max(n, 1))
    row = F.xxhash64(*keys, F.lit(seed))
    offers = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                    lambda k: F.struct(k.alias("tree_id"), F.shiftrightunsigned(F.xxhash64(F.col("_row"), k), 1).alias("_h"))),
        lambda o: o["_h"] <= F.lit(limit))
    sampled = df.withColumn("_row", row).select(*cols, F.explode(offers).alias("_o")).select(*cols, "_o.tree_id", "_o._h")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        rng = np.random.default_rng(seed * 100003 + tid)
        x = pdf.sort_values(["_h", *cols])[cols].to_numpy(dtype=float)[:psi]
        feat, thr, left, right, size = _grow(x, rng, max_depth)
        return pd.DataFrame({"tree_id": [tid], "feat": [feat.tolist()], "thr": [thr.tolist()],
                             "left": [left.tolist()], "right": [right.tolist()], "size": [size.tolist()]})

    trees = sampled.groupBy("tree_id").applyInPandas(
        grow, "tree_id int, feat array<int>, thr array<double>, left array<int>, right array<int>, size array<double>"
    ).orderBy("tree_id").collect()  # bounded: n_trees x (2^(max_depth+1)) nodes
    forest = [(np.array(r["feat"]), np.array(r["thr"]), np.array(r["left"]), np.array(r["right"]),
               np.array(r["size"])) for r in trees]
    return {"trees": forest, "psi": psi, "cols": cols}


def score_isolation_forest(df: DataFrame, model: dict, out_col: str = "anomaly_score") -> DataFrame:
    """score = -2^(-E[h(x)] / c(psi)) (lower = more anomalous), vectorised per Arrow batch."""
    forest, psi, cols = model["trees"], model["psi"], model["cols"]
    cpsi = _c(psi)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.DoubleType())])

    def scorer(it):
        for pdf in it:
            x = pdf[cols].to_numpy(dtype=float)
            h = np.zeros(len(x))
            for tree in forest:
                h += _path_lengths(x, tree)
            h /= max(len(forest), 1)
            pdf[out_col] = -np.power(2.0, -h / cpsi) if cpsi > 0 else -0.5
            yield pdf

    return df.mapInPandas(scorer, schema)


def label_anomalies(scored: DataFrame, contamination: float = 0.08, score_col: str = "anomaly_score") -> DataFrame:
    """threshold = exact ``contamination`` quantile of the scores; the score is given relative
    to it (``anomaly_score`` < 0: anomaly)."""
    thr = exact_quantiles(scored, [score_col], contamination)[score_col]
    shifted = F.col(score_col) - F.lit(thr)
    return scored.withColumn("anomaly_label", (F.col(score_col) < F.lit(thr)).cast("int")).withColumn(
        "anomaly_threshold", F.lit(thr)).withColumn("anomaly_score", shifted)


def isolation_forest(gold: DataFrame, cols=ANOMALY_FEATURES, n_trees: int = 200, contamination: float = 0.08,
                     seed: int = 42) -> DataFrame:
    """Device-days with their features, offset score and label; scored rows are written once."""
    base = gold.select("device_id", "date", *cols).fillna(0)
    z = zscore(base.select("device_id", "date", *cols, *[F.col(c).alias(f"z_{c}") for c in cols]), [f"z_{c}" for c in cols])
    scaled = [f"z_{c}" for c in cols]
    model = fit_isolation_forest(z, scaled, n_trees=n_trees, seed=seed)
    scored = materialize(score_isolation_forest(z, model).drop(*scaled), "isolation-scores")
    return label_anomalies(scored, contamination)


# ---------------------------------------------------------------- A8 / A9 / A10
def device_anomaly_summary(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("device_id").agg(
        F.sum("anomaly_label").alias("anomaly_count"), F.count(F.lit(1)).alias("total_days")).withColumn(
        "anomaly_rate", F.col("anomaly_count") / F.col("total_days"))


def anomaly_feature_diff(labeled: DataFrame, cols=SPC_FEATURES) -> DataFrame:
    """Mean per feature for anomalous vs normal rows; % difference (normal mean 0 -> 1)."""
    a = F.col("anomaly_label") == 1
    one = labeled.agg(*[x for c in cols for x in (F.avg(F.when(a, F.col(c))).alias(f"{c}_a"),
                                                  F.avg(F.when(~a, F.col(c))).alias(f"{c}_n"))])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}_a").alias("anomaly_mean"),
                     F.col(f"{c}_n").alias("normal_mean")) for c in cols]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    den = F.when(F.col("normal_mean") == 0, F.lit(1.0)).otherwise(F.col("normal_mean"))
    return long.withColumn("pct_diff", (F.col("anomaly_mean") - F.col("normal_mean")) / den * 100)


def daily_anomaly_rate(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("date").agg((F.avg("anomaly_label") * 100).alias("anomaly_rate_pct"))


def fleet_daily_means(df: DataFrame, cols=SPC_FEATURES) -> DataFrame:
    """A10: one row per (date, feature) with the fleet mean (bounded by days x features)."""
    g = df.groupBy("date").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("daily_mean")) for c in cols]
    return g.select("date", F.explode(F.array(*rows)).alias("r")).select("date", "r.*")


# ---------------------------------------------------------------- W12 / A21
def spc_limits(df: DataFrame, cols=SPC_FEATURES, baseline_days: int = 7) -> DataFrame:
    """Control limits from the first ``baseline_days`` daily means (per feature)."""
    dm = fleet_daily_means(df, cols)
    w = Window.partitionBy("feature").orderBy("date")  # over the per-day table
    base = dm.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= baseline_days)
    lim = base.groupBy("feature").agg(F.avg("daily_mean").alias("center_line"),
                                      F.stddev_samp("daily_mean").alias("sigma"))
    s = F.col("sigma")
    return lim.select("feature", "center_line", "sigma",
                      (F.col("center_line") + 3 * s).alias("ucl"), (F.col("center_line") - 3 * s).alias("lcl"),
                      (F.col("center_line") + 2 * s).alias("uwl"), (F.col("center_line") - 2 * s).alias("lwl"))


def spc_points(df: DataFrame, cols=SPC_FEATURES, baseline_days: int = 7) -> DataFrame:
    dm = fleet_daily_means(df, cols)
    lim = spc_limits(df, cols, baseline_days)
    j = dm.join(lim, "feature")  # limits: one row per feature
    x = F.col("daily_mean")
    viol = (x > F.col("ucl")) | (x < F.col("lcl"))
    warn = ((x > F.col("uwl")) & (x <= F.col("ucl"))) | ((x < F.col("lwl")) & (x >= F.col("lcl")))
    return j.select("date", "feature", "daily_mean", "center_line", "ucl", "lcl", "uwl", "lwl",
                    viol.alias("violation"), warn.alias("warning"))


def spc_summary(df: DataFrame, cols=SPC_FEATURES) -> DataFrame:
    p = spc_points(df, cols)
    return p.groupBy("feature").agg(
        F.count_if("violation").alias("violations"), F.count_if("warning").alias("warnings"),
        F.round(F.first("center_line"), 3).alias("center_line"), F.round(F.first("ucl"), 3).alias("ucl"),
        F.round(F.first("lcl"), 3).alias("lcl"))


def western_electric_rule2(df: DataFrame, cols=SPC_FEATURES) -> DataFrame:
    """2 of 3 consecutive daily means beyond 2 sigma of a rolling 7-day baseline."""
    dm = fleet_daily_means(df, cols)
    w = Window.partitionBy("feature").orderBy("date")
    base = w.rowsBetween(-7, -1)
    mu, sd = F.avg("daily_mean").over(base), F.stddev_samp("daily_mean").over(base)
    x = dm.select("date", "feature", "daily_mean", mu.alias("mu"), sd.alias("sd"))
    beyond = (F.abs(F.col("daily_mean") - F.col("mu")) > 2 * F.col("sd")).cast("int")
    y = x.withColumn("beyond", F.coalesce(beyond, F.lit(0)))
    return y.withColumn("rule2_warning", F.sum("beyond").over(w.rowsBetween(-2, 0)) >= 2)


def count_outside_limits(points: DataFrame, limits: DataFrame, cols=SPC_FEATURES) -> DataFrame:
    """Values outside stored control limits, per feature, in one pass over the rows
    (the limits are one row a feature, taken as literals)."""
    lim = {r["feature"]: (r["lcl"], r["ucl"]) for r in limits.collect()}
    cols = [c for c in cols if c in lim]
    one = points.agg(*[F.count_if((F.col(c) > F.lit(lim[c][1])) | (F.col(c) < F.lit(lim[c][0]))).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("outside")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
