"""Queries that apply a fitted model, against the fit; the Cox fit against the plain Efron likelihood."""

import math

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from turnstile.operators import survival as sv


def plain_efron(beta, x, t, event, penalizer):
    out = -0.5 * penalizer * float(beta @ beta)
    eta = x @ beta
    for day in sorted(set(t[event == 1])):
        tied = (t == day) & (event == 1)
        risk, own, d = np.exp(eta[t >= day]).sum(), np.exp(eta[tied]).sum(), int(tied.sum())
        out += eta[tied].sum() - sum(math.log(risk - k / d * own) for k in range(d))
    return out


def cox_frame(spark, n=200, seed=4, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, scale, 1]
    t = np.ceil(rng.exponential(8 * np.exp(-0.7 * x[:, 0] + 0.4 * x[:, 2]))).astype(int)  # many ties
    event = (rng.random(n) < 0.7).astype(int)
    rows = [(int(i), int(a), int(e), *map(float, v)) for i, (a, e, v) in enumerate(zip(t, event, x))]
    return spark.createDataFrame(rows, "device_id int, duration_days int, event int, a double, b double, c double"), x, t, event


def test_cox_is_the_maximum_of_the_efron_likelihood(spark):
    df, x, t, event = cox_frame(spark)
    assert max(np.bincount(t[event == 1])) > 10
    fit = sv.fit_cox(df, ["a", "b", "c"], penalizer=0.1)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    beta = np.array([fit["coef"][c] for c in "abc"])
    best = plain_efron(beta, z, t, event, 0.1)
    assert math.isclose(fit["loglik"] - 0.05 * beta @ beta, best, rel_tol=1e-10)
    h = 1e-5
    for i in range(3):
        e = np.eye(3)[i] * h
        assert abs(plain_efron(beta + e, z, t, event, 0.1) - plain_efron(beta - e, z, t, event, 0.1)) / (2 * h) < 1e-4
        second = (plain_efron(beta + 10 * e, z, t, event, 0.1) - 2 * best + plain_efron(beta - 10 * e, z, t, event, 0.1)) / (100 * h * h)
        assert second < 0
    assert beta[0] > 0.4 and beta[2] < -0.2


def test_cox_with_huge_covariates(spark):
    """Unscaled covariates in the thousands: no overflow, steps halved where Newton leaps too far."""
    df, x, t, event = cox_frame(spark, seed=6)
    df = df.withColumn("is_old_device", F.when(F.col("device_id") == 0, 4000.0).otherwise(F.col("a") * 20))
    fit = sv.fit_cox(df, ["is_old_device", "c"], penalizer=0.1)
    assert all(math.isfinite(v) for v in (*fit["coef"].values(), *fit["se"].values(), fit["loglik"]))


def test_fitted_queries_read_the_stored_fit(spark):
    q = {k: f for k, f in E.queries().items()}
    fit = q["m24_weibull"](spark, SF_SMALL).first()
    lam, rho = fit["lambda_"], fit["rho_"]
    assert (lam, rho) != (40.0, 1.3)
    for r in q["m25_weibull_curves_fitted"](spark, SF_SMALL).collect():
        assert math.isclose(r.survival, math.exp(-((r.t / lam) ** rho)), abs_tol=1e-4)
    r = q["m26_reliability_fitted"](spark, SF_SMALL).first()
    assert math.isclose(r.reliability_30d, math.exp(-((30 / lam) ** rho)), abs_tol=1e-4)
    rul = {r.device_id: r for r in q["m31_rul_fitted"](spark, SF_SMALL).collect()}
    sla = q["m32_sla_risk_fitted"](spark, SF_SMALL).collect()
    assert len(sla) == len(rul) and all(r.rul_median_days == rul[r.device_id].rul_median_days for r in sla)
    a13 = q["a13_rul_fleet_metrics_fitted"](spark, SF_SMALL).first()
    assert math.isclose(a13.mean_rul, np.mean([r.rul_median_days for r in rul.values()]), abs_tol=1e-5)
    groups = {r.risk_group: r.devices for r in q["m30_risk_groups_fitted"](spark, SF_SMALL).collect()}
    assert abs(groups["High Risk"] - groups["Low Risk"]) <= 1 and sum(groups.values()) == len(rul)


def test_fitted_labels(spark):
    q = E.queries()
    labels = q["m22_isolation_forest"](spark, SF_SMALL).collect()
    found = sum(r.anomaly_label for r in labels)
    assert q["a25_anomaly_threshold_fitted"](spark, SF_SMALL).first().anomalies == found
    assert q["a8_device_anomalies_fitted"](spark, SF_SMALL).agg(F.sum("anomaly_count")).first()[0] == found
    assert q["a10_daily_anomaly_rate_fitted"](spark, SF_SMALL).count() == len({r.date for r in labels})
    assert q["m33_annotated_anomalies_fitted"](spark, SF_SMALL).agg(F.sum("anomaly_label")).first()[0] == found
    mapped = q["p26_anomaly_feature_map_fitted"](spark, SF_SMALL)
    assert mapped.where("is_anomaly").select("device_id", "date").distinct().count() == found
    assert q["a9_anomaly_feature_diff_fitted"](spark, SF_SMALL).count() == q["a9_anomaly_feature_diff"](spark, SF_SMALL).count()


def test_hypotheses_run_side_by_side_and_match_without_confounders(spark, monkeypatch):
    import threading

    from turnstile.operators import causes as cz

    rows = [(i, f"2024-01-{1 + i % 28:02d}", i % 7, float(i % 11), float(i % 5), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "device_id int, date string, error_count int, temperature_c double, age_days double, y int")
    features = ["error_count", "temperature_c", "age_days"]
    alone, nearest, both, seen = cz.matching_ate, cz.nearest_opposite, threading.Barrier(3, timeout=60), []

    def together(*args):
        both.wait()  # broken unless all three hypotheses have begun
        return alone(*args)

    def watched(p, *args):
        seen.append(p.columns)
        return nearest(p, *args)

    monkeypatch.setattr(cz, "nearest_opposite", watched)
    monkeypatch.setattr(cz, "matching_ate", together)
    got = [tuple(r) for r in cz.causal_effects(df, "y", features).collect()]
    assert seen == [["_treat", "y", "_key", "ps"]] * 3
    monkeypatch.setattr(cz, "matching_ate", alone)
    want = []
    for t, text in [h for h in cz.HYPOTHESES if h[0] in df.columns]:  # by hand, one after the other
        x = df.withColumn("_treat", (F.col(t) > cz.exact_median(df, [t])[t]).cast("int"))
        ate = alone(x, "_treat", "y", [c for c in features if c != t])
        want.append((t, text, round(ate, 4), abs(ate) > 0.01))
    assert got == want
