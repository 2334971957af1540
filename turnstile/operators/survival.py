"""Survival analysis (M23-M32, W17-W18) as Spark jobs.

Durations are whole days, so every estimator first aggregates to one row per
distinct duration (bounded by the observation horizon, not by the fleet size);
fits then iterate over those small aggregates.  Cox regression needs covariates,
so each Newton step is one grouped aggregation by duration over the devices.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.exprs import np_round
from turnstile.functions.stats import exact_median, normal_sf

# Survival covariates and their defaults when missing.
COVARIATE_DEFAULTS = {
    "age_days": 0, "health_score": 50.0, "error_count_7d_mean": 0.0, "signal_strength_dbm_7d_mean": 80.0,
    "temperature_c_7d_mean": 35.0, "cumulative_errors": 0, "total_maintenance_count": 0,
    "is_old_device": 0, "is_beta_firmware": 0, "sla_compliance_rate": 1.0,
}
COX_COVARIATES = ["age_days", "health_score", "error_count_7d_mean", "signal_strength_dbm_7d_mean",
                  "temperature_c_7d_mean", "cumulative_errors", "total_maintenance_count",
                  "is_old_device", "is_beta_firmware"]
COX_UNSCALED = {"is_old_device", "is_beta_firmware"}


# ---------------------------------------------------------------- M23 / W11 / P25
def survival_dataset(gold: DataFrame) -> DataFrame:
    """One row per device: duration_days, event, latest covariates (defaults when NULL).

    Event: days from first observation to first failure + 1; censored: the
    number of observed rows (as executed).  Clamped to >= 1.
    """
    cov = list(COVARIATE_DEFAULTS)
    g = gold.groupBy("device_id").agg(
        F.min("date").alias("start"),
        F.min(F.when(F.col("failure_today") == 1, F.col("date"))).alias("first_failure"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max_by(F.struct(*[F.col(c) for c in cov]), F.col("date")).alias("latest"),
    )
    event = F.col("first_failure").isNotNull()
    dur = F.when(event, F.datediff("first_failure", "start") + 1).otherwise(F.col("n_rows"))
    return g.select(
        "device_id",
        F.greatest(F.lit(1), dur).cast("int").alias("duration_days"),
        event.cast("int").alias("event"),
        *[F.coalesce(F.col(f"latest.{c}"), F.lit(v)).alias(c) for c, v in COVARIATE_DEFAULTS.items()],
    )


def duration_table(surv: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """(group..., t, n_t = devices with duration t, d_t = events at t)."""
    group_cols = group_cols or []
    return surv.groupBy(*group_cols, F.col("duration_days").alias("t")).agg(
        F.count(F.lit(1)).alias("n_t"), F.sum("event").alias("d_t"))


# ---------------------------------------------------------------- W17 / M27
def kaplan_meier(surv: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """KM estimate per distinct time (and group): at_risk, events, survival.

    The window runs over the per-duration table (one row per day of horizon)."""
    group_cols = group_cols or []
    dt = duration_table(surv, group_cols)
    w = Window.partitionBy(*group_cols).orderBy("t")
    before = F.coalesce(F.sum("n_t").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n_t").over(Window.partitionBy(*group_cols))
    x = dt.select(*group_cols, "t", "n_t", "d_t", (total - before).alias("at_risk"))
    factor = F.lit(1.0) - F.col("d_t") / F.col("at_risk")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    zero_seen = F.max((F.col("d_t") == F.col("at_risk")).cast("int")).over(run)
    logs = F.sum(F.when(F.col("d_t") < F.col("at_risk"), F.log(factor)).otherwise(F.lit(0.0))).over(run)
    return x.select(*group_cols, F.col("t").alias("timeline"), "at_risk", F.col("d_t").alias("observed"),
                    (F.col("n_t") - F.col("d_t")).alias("censored"),
                    F.when(zero_seen > 0, F.lit(0.0)).otherwise(F.exp(logs)).alias("survival"))


# ---------------------------------------------------------------- M24
def fit_weibull(surv: DataFrame) -> dict:
    """Right-censored Weibull MLE (scale lambda, shape rho) on the per-duration table.

    Profile likelihood in rho (lambda^rho = sum t^rho / D), maximised by
    bracketing + golden section on log rho; the table has one row per distinct
    whole day of the observation horizon (a calendar, not the fleet)."""
    rows = duration_table(surv).collect()
    t = np.array([float(r["t"]) for r in rows])
    n = np.array([float(r["n_t"]) for r in rows])
    d = np.array([float(r["d_t"]) for r in rows])
    D = d.sum()
    if D == 0:
        return {"lambda_": float("nan"), "rho_": float("nan"), "events": 0, "n": int(n.sum())}
    lt = np.log(t)
    sum_d_logt = float((d * lt).sum())

    def loglik(logrho):
        rho = math.exp(logrho)
        s = float((n * np.exp(rho * lt)).sum())
        return D * math.log(rho) - D * math.log(s / D) + (rho - 1) * sum_d_logt - D

    a, b = math.log(0.01), math.log(100.0)
    gr = (math.sqrt(5) - 1) / 2
    c, e = b - gr * (b - a), a + gr * (b - a)
    for _ in range(200):
        if loglik(c) > loglik(e):
            b = e
        else:
            a = c
        c, e = b - gr * (b - a), a + gr * (b - a)
    rho = math.exp((a + b) / 2)
    lam = (float((n * np.exp(rho * lt)).sum()) / D) ** (1 / rho)
    interp = ("Increasing failure rate (wear-out)" if rho > 1 else
              "Decreasing failure rate (infant mortality)" if rho < 1 else "Constant failure rate (random)")
    return {"lambda_": float(lam), "rho_": float(rho), "events": int(D), "n": int(n.sum()), "interpretation": interp}


def weibull_params(surv: DataFrame) -> DataFrame:
    p = fit_weibull(surv)
    return surv.sparkSession.createDataFrame(
        [(p["lambda_"], p["rho_"], p["events"], p["n"], p.get("interpretation"))],
        "lambda_ double, rho_ double, events int, n int, interpretation string")


# ---------------------------------------------------------------- M25 / M26
def weibull_curves(spark, lam: float, rho: float, t_max: int = 90) -> DataFrame:
    t = F.col("t").cast("double")
    z = F.pow(t / lam, F.lit(rho))
    return spark.range(1, t_max + 1).select(
        F.col("id").cast("int").alias("t"), F.exp(-z).alias("survival"),
        (F.lit(rho / lam) * F.pow(t / lam, F.lit(rho - 1))).alias("hazard"), z.alias("cumulative_hazard"))


def reliability(df: DataFrame, lam: float, rho: float, days=(7, 14, 21, 30)) -> DataFrame:
    return df.select("*", *[F.exp(-F.pow(F.lit(float(x)) / lam, F.lit(rho))).alias(f"reliability_{x}d")
                            for x in days])


# ---------------------------------------------------------------- M31 / W18
def rul(surv: DataFrame, lam: float, rho: float, horizon: int = 90) -> DataFrame:
    """Smallest offset t in 0..horizon-1 with S(age+t) < S(age)/2, else horizon; tier.

    For a Weibull S the condition is t > lam * ((age/lam)^rho + ln 2)^(1/rho) - age, so
    the offset is the next whole day; an age whose S is 0 has no half to fall below."""
    age = F.col("duration_days")
    z = F.pow(age.cast("double") / lam, F.lit(float(rho)))
    cur = F.exp(-z)
    half = F.lit(float(lam)) * F.pow(z + F.lit(math.log(2.0)), F.lit(1.0 / rho)) - age
    r = F.when(cur <= 0, F.lit(horizon)).otherwise(
        F.least(F.lit(float(horizon)), F.floor(half) + 1).cast("int"))
    tier = F.when(r <= 7, "CRITICAL").when(r <= 14, "HIGH").when(r <= 30, "MEDIUM").otherwise("LOW")
    return surv.select("device_id", age.alias("current_age_days"), r.alias("rul_median_days"),
                       np_round(cur, 4).alias("current_survival_prob"), F.col("event").alias("event_observed"),
                       "health_score", tier.alias("risk_tier"))


# ---------------------------------------------------------------- M32 / J4 / J10
def sla_risk(surv: DataFrame, rul_df: DataFrame) -> DataFrame:
    """Breach probability and 0-100 score; a fleet without any error has error share 0."""
    m = surv.join(rul_df.select("device_id", "rul_median_days", "risk_tier"), "device_id", "left")
    max_err = surv.agg(F.max("cumulative_errors")).first()[0] or 0  # one scalar
    breach = np_round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(0.1) * (F.col("rul_median_days") - 15))), 4)
    err_share = F.col("cumulative_errors") / F.lit(float(max_err)) if max_err else F.lit(0.0)
    m = m.withColumn("sla_breach_prob", breach)
    score = ((1 - F.col("health_score") / 100) * 30 + F.col("sla_breach_prob") * 40 + err_share * 20
             + F.col("is_old_device") * 10)
    return m.withColumn("sla_risk_score", np_round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)), 1))


def rul_fleet_metrics(rul_df: DataFrame) -> DataFrame:
    """Mean RUL, devices per tier, devices with RUL < 14."""
    return rul_df.agg(
        F.avg("rul_median_days").alias("mean_rul"),
        *[F.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_devices") for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
        F.count_if(F.col("rul_median_days") < 14).alias("rul_lt_14"),
    )


# ---------------------------------------------------------------- M28 / M30
def standardize(surv: DataFrame, cols=COX_COVARIATES, skip=COX_UNSCALED) -> tuple[DataFrame, dict]:
    """Sample-std z-scores (skipped when std is 0); returns scaled frame and (mean, std) per column."""
    scale = [c for c in cols if c not in skip]
    st = surv.agg(*[x for c in scale for x in (F.avg(c).alias(f"{c}_m"), F.stddev_samp(c).alias(f"{c}_s"))]).first()
    params = {c: (st[f"{c}_m"], st[f"{c}_s"]) for c in scale}
    out = [F.col(c) for c in surv.columns if c not in cols]
    for c in cols:
        m, s = params.get(c, (None, None))
        if c in params and s and s > 0:
            out.append(((F.col(c) - m) / s).alias(c))
        else:
            out.append(F.col(c).cast("double").alias(c))
    return surv.fillna(0).select(*out), params


def _efron(rows, beta: np.ndarray, penalizer: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, gradient and second derivatives from sums by duration, the longest first (running sums are the risk sets).

    Of d events on one day, each takes a further d-th of the day's events out of the risk set: with a = 0, 1/d, ... (d - 1)/d the risk set is
    S - a D.  The sums over a are five numbers, so many ties cost no more than few."""
    p = len(beta)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]

    def sums(r, kind):
        s2 = np.zeros((p, p))
        for i, j in pairs:
            s2[i, j] = s2[j, i] = r[f"{kind}2_{i}_{j}"]
        return np.array([r[f"{kind}0"]]), np.array([r[f"{kind}1_{i}"] for i in range(p)]), s2

    ll, grad, hess = 0.0, np.zeros(p), np.zeros((p, p))
    risk = (np.zeros(1), np.zeros(p), np.zeros((p, p)))
    for r in rows:
        risk = tuple(x + y for x, y in zip(risk, sums(r, "s")))
        d = int(r["d"])
        if not d:
            continue
        (s0, s1, s2), (t0, t1, t2) = risk, sums(r, "t")
        share = np.arange(d) / d
        left = s0[0] - share * t0[0]
        one, part = (1 / left).sum(), (share / left).sum()
        xe = np.array([r[f"xe_{i}"] for i in range(p)])
        ll += float(xe @ beta) - d * r["shift"] - float(np.log(left).sum())
        grad += xe - s1 * one + t1 * part
        cross = np.outer(s1, t1)
        hess -= s2 * one - t2 * part - (np.outer(s1, s1) * (1 / left ** 2).sum() - (cross + cross.T) * (share / left ** 2).sum()
                                        + np.outer(t1, t1) * (share ** 2 / left ** 2).sum())
    return ll - 0.5 * penalizer * float(beta @ beta), grad - penalizer * beta, hess - penalizer * np.eye(p)


def fit_cox(surv: DataFrame, cols=COX_COVARIATES, penalizer: float = 0.1, max_iter: int = 50,
            tol: float = 1e-7) -> dict:
    """Cox PH with ridge penalty (0.5 * penalizer * |beta|^2), Efron ties.

    Each Newton step is one aggregation by duration of exp(x.b), x exp(x.b) and
    x x' exp(x.b) (p*p sums), over all devices and over those with an event; only the small per-duration result
    reaches the driver.  x.b is taken less its maximum where exp could overflow.  A step that lowers the
    likelihood is halved."""
    x, _ = standardize(surv, cols)
    # the per-device design is re-read by every Newton step: keep it (recomputable cache)
    x = x.select("duration_days", "event", *cols).persist()
    largest = x.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in cols]).first()
    largest = np.array([float(largest[c] or 0.0) for c in cols])

    def evaluate(beta):
        eta = sum((F.col(c) * float(b) for c, b in zip(cols, beta)), F.lit(0.0))
        shift = float(x.agg(F.max(eta)).first()[0] or 0.0) if float(np.abs(beta) @ largest) > 300 else 0.0
        w = F.exp(eta - F.lit(shift))
        aggs = [F.sum("event").alias("d"), F.lit(shift).alias("shift")]
        for kind, v in (("s", w), ("t", F.when(F.col("event") == 1, w).otherwise(F.lit(0.0)))):
            aggs += [F.sum(v).alias(f"{kind}0"), *[F.sum(F.col(c) * v).alias(f"{kind}1_{i}") for i, c in enumerate(cols)]]
            aggs += [F.sum(F.col(a) * F.col(b) * v).alias(f"{kind}2_{i}_{j}")
                     for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
        aggs += [F.sum(F.col(c) * F.col("event")).alias(f"xe_{i}") for i, c in enumerate(cols)]
        rows = x.groupBy("duration_days").agg(*aggs).orderBy(F.col("duration_days").desc()).collect()
        return _efron(rows, beta, penalizer)

    beta = np.zeros(len(cols))
    ll, grad, hess = evaluate(beta)
    step = -np.linalg.solve(hess, grad)
    for _ in range(max_iter):
        trial = evaluate(beta + step)
        if trial[0] < ll - 1e-9 * max(1.0, abs(ll)):
            step = step / 2
        else:
            beta, (ll, grad, hess) = beta + step, trial
            if np.max(np.abs(step)) < tol:
                break
            step = -np.linalg.solve(hess, grad)
        if np.max(np.abs(step)) < tol * 1e-3:
            break
    x.unpersist()
    cov = np.linalg.inv(-hess)
    se = np.sqrt(np.diag(cov))
    z = beta / se
    pvals = [2 * normal_sf(abs(v)) for v in z]
    return {"coef": dict(zip(cols, beta.tolist())), "se": dict(zip(cols, se.tolist())),
            "p": dict(zip(cols, pvals)), "loglik": ll + 0.5 * penalizer * float(beta @ beta)}


def cox_summary(surv: DataFrame, penalizer: float = 0.1, fit: dict | None = None) -> DataFrame:
    fit = fit or fit_cox(surv, penalizer=penalizer)
    rows = [(c, fit["coef"][c], float(math.exp(fit["coef"][c])), fit["se"][c], fit["p"][c], fit["p"][c] < 0.05)
            for c in COX_COVARIATES]
    return surv.sparkSession.createDataFrame(
        rows, "covariate string, coef double, hazard_ratio double, se double, p double, significant boolean")


def partial_hazard(surv: DataFrame, coef: dict) -> DataFrame:
    x, _ = standardize(surv, list(coef))
    eta = sum((F.col(c) * float(b) for c, b in coef.items()), F.lit(0.0))
    return x.select("device_id", "duration_days", "event", F.exp(eta).alias("partial_hazard"))


def risk_groups(ph: DataFrame) -> DataFrame:
    """High risk = partial hazard above the (exact, distributed) median; a missing hazard is no high risk."""
    med = exact_median(ph, ["partial_hazard"])["partial_hazard"]
    return ph.withColumn("risk_group", F.when(F.col("partial_hazard") > F.lit(med), "High Risk").otherwise("Low Risk"))


# ---------------------------------------------------------------- M29
def concordance_index(df: DataFrame, risk_col: str = "partial_hazard") -> DataFrame:
    """Harrell's C: over pairs with t_i < t_j and event_i, share with risk_i > risk_j (ties 1/2).

    No pair is materialised.  Durations form a binary tree: a device of duration d belongs to
    one node per level, (level, d >> level); the durations later than t are the right siblings
    on t's path, at most one per level.  Devices and events meet in a risk-ordered running
    count per node, so a row is replicated log2(horizon) times, whatever the fleet.
    """
    from turnstile.functions.stats import bucketed_prefix_sums

    pts = df.groupBy(F.col("duration_days").cast("long").alias("t"), F.col(risk_col).alias("r")).agg(
        F.count(F.lit(1)).alias("n_all"), F.sum(F.col("event").cast("long")).alias("n_event"))
    levels = int(pts.agg(F.max("t")).first()[0] or 0).bit_length()  # one scalar
    own, later = [], []
    for k in range(levels + 1):
        node = F.shiftright("t", k)
        own.append(F.struct(F.lit(k).alias("level"), node.alias("node")))
        later.append(F.when(node % 2 == 0, F.struct(F.lit(k).alias("level"), (node + 1).alias("node"))))
    data = pts.select(F.explode(F.array(*own)).alias("at"), "r", F.col("n_all").alias("n_data"), F.lit(0).cast("long").alias("n_q"))
    asked = (pts.where("n_event > 0").select(F.explode(F.array_compact(F.array(*later))).alias("at"), "r",
                                             F.lit(0).cast("long").alias("n_data"), F.col("n_event").alias("n_q")))
    u = data.unionByName(asked).groupBy("at.level", "at.node", "r").agg(F.sum("n_data").alias("n_data"), F.sum("n_q").alias("n_q"))
    ps = bucketed_prefix_sums(u, ["level", "node"], "r", ["n_data"], inclusive=False)
    # devices of a later duration: in all of the node / with lower risk
    total = u.groupBy("level", "node").agg(F.sum("n_data").alias("in_node"), F.sum("n_q").alias("asked"))
    den = total.agg(F.sum(F.col("in_node") * F.col("asked"))).first()[0] or 0  # one scalar
    conc = ps.agg(F.sum(F.col("n_q") * (F.col("cum_n_data") + 0.5 * F.col("n_data"))).alias("c"))
    return conc.select(
        (F.col("c") / F.lit(float(den)) if den else F.lit(None).cast("double")).alias("concordance_index"),
        F.lit(int(den)).cast("bigint").alias("comparable_pairs"))
