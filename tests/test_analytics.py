"""Patterns, CDC, survival, drift, anomaly and ML operators: invariants and planted signals."""

import math

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from turnstile.operators import anomaly, causes, cdc, drift, failure, patterns, survival
from turnstile.sources.canonical import Fleet


def test_markov_rows_sum_to_one(spark):
    e = Fleet(spark, SF_SMALL).error_logs()
    m = patterns.transition_matrix(e)
    codes = [c for c in m.columns if c != "from_error"]
    for r in m.collect():
        s = sum(r[c] for c in codes)
        assert math.isclose(s, 1.0, abs_tol=1e-9) or s == 0.0


def test_rules_have_multi_item_consequents_when_triples_are_frequent(spark):
    rows = []
    for i in range(40):
        for c in ("A", "B", "C"):
            rows.append((i, "2024-01-01 10:00:00", c, i * 10 + ord(c)))
    e = spark.createDataFrame(rows, "device_id int, timestamp string, error_code string, event_id int") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    fi = patterns.frequent_itemsets(e)
    r = patterns.association_rules(fi, 0.3)
    cons = {x.consequents for x in r.collect()}
    assert "B, C" in cons and all(math.isclose(x.confidence, 1.0) for x in r.collect())


def test_cdc_apply_reproduces_the_new_batch(spark):
    old = spark.createDataFrame([(1, "d", 1.0), (2, "d", 2.0), (3, "d", 3.0)], "device_id int, date string, v double")
    new = spark.createDataFrame([(1, "d", 1.0), (2, "d", 20.0), (4, "d", 4.0)], "device_id int, date string, v double")
    ch = cdc.detect_changes(old, new, ["device_id", "date"])
    kinds = {r.device_id: r.change_type for r in ch.collect()}
    assert kinds == {1: "UNCHANGED", 2: "UPDATE", 3: "DELETE", 4: "INSERT"}
    merged = cdc.apply_changes(old, ch, ["device_id", "date"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, new.collect()))


def test_table_hash_ignores_order_and_metadata(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    b = spark.createDataFrame([(2, 3.0), (1, 2.0)], "k int, v double").withColumn("_ingested_at", F.current_timestamp())
    assert cdc.table_hash(a).first() == cdc.table_hash(b).first()


def test_incremental_features_equal_batch(spark):
    import __spark_entry__ as E
    from turnstile.plans.oracle import ORACLE  # noqa: F401

    df = E.queries()["c6_incremental_features"](spark, SF_SMALL)
    g = Fleet(spark, SF_SMALL).gold().where(F.col("date") >= F.lit("2024-01-21").cast("date"))
    assert df.count() == g.count()
    j = df.join(g.select("device_id", "date", F.col("cumulative_errors").alias("b")), ["device_id", "date"])
    assert j.where(F.col("cumulative_errors") != F.col("b")).count() == 0


def test_kaplan_meier_non_increasing(spark):
    s = survival.survival_dataset(Fleet(spark, SF_SMALL).gold())
    km = [r.survival for r in survival.kaplan_meier(s).orderBy("timeline").collect()]
    assert all(a >= b - 1e-12 for a, b in zip(km, km[1:]))


def test_weibull_recovers_planted_parameters(spark):
    rng = np.random.default_rng(3)
    lam, rho = 20.0, 1.7
    t = lam * rng.weibull(rho, 4000)
    cens = rng.uniform(5, 60, 4000)
    dur = np.maximum(1, np.ceil(np.minimum(t, cens))).astype(int)
    ev = (t <= cens).astype(int)
    df = spark.createDataFrame([(int(i), int(d), int(e)) for i, (d, e) in enumerate(zip(dur, ev))],
                               "device_id int, duration_days int, event int")
    p = survival.fit_weibull(df)
    assert abs(p["lambda_"] - lam) / lam < 0.08 and abs(p["rho_"] - rho) / rho < 0.12


def test_concordance_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    n = 300
    dur = rng.integers(1, 20, n)
    ev = rng.integers(0, 2, n)
    risk = np.round(rng.random(n), 2)
    df = spark.createDataFrame([(int(i), int(d), int(e), float(r)) for i, (d, e, r) in enumerate(zip(dur, ev, risk))],
                               "device_id int, duration_days int, event int, partial_hazard double")
    got = survival.concordance_index(df).first().concordance_index
    num = den = 0.0
    for i in range(n):
        if not ev[i]:
            continue
        for j in range(n):
            if dur[j] > dur[i]:
                den += 1
                num += 1.0 if risk[i] > risk[j] else 0.5 if risk[i] == risk[j] else 0.0
    assert math.isclose(got, num / den, abs_tol=1e-12)


def test_ks_equal_samples_not_drifted(spark):
    rows = [("2024-01-%02d" % (1 + i % 30), float(i % 17)) for i in range(3000)]
    df = spark.createDataFrame(rows, "date string, x double").withColumn("date", F.to_date("date"))
    t = drift.split_at_nth_date(df, 20)
    r = drift.ks_drift(t, ["x"]).first()
    assert r.ks_statistic < 0.05 and not r.drifted


def test_ks_shifted_sample_drifted(spark):
    rows = [("2024-01-%02d" % (1 + i % 30), float(i % 17) + (10.0 if i % 30 >= 20 else 0.0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "date string, x double").withColumn("date", F.to_date("date"))
    r = drift.ks_drift(drift.split_at_nth_date(df, 20), ["x"]).first()
    assert r.drifted and r.ks_statistic > 0.5


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(11)
    normal = rng.normal(0, 1, (2000, 3))
    out = rng.normal(0, 1, (40, 3)) + 8
    x = np.vstack([normal, out])
    df = spark.createDataFrame([(int(i), *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    m = anomaly.fit_isolation_forest(df, ["a", "b", "c"], n_trees=50, seed=1)
    scored = anomaly.label_anomalies(anomaly.score_isolation_forest(df, m), 0.02)
    hits = scored.where((F.col("id") >= 2000) & (F.col("anomaly_label") == 1)).count()
    assert hits >= 36


def test_matching_recovers_planted_effect(spark):
    rng = np.random.default_rng(2)
    n = 3000
    z = rng.normal(0, 1, n)
    treat = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    y = (rng.random(n) < 0.2 + 0.3 * treat + 0.2 * (z > 0)).astype(int)  # true ATE 0.3
    df = spark.createDataFrame([(int(t), int(v), float(a)) for t, v, a in zip(treat, y, z)], "t int, y int, z double")
    ate = causes.matching_ate(df, "t", "y", ["z"])
    assert 0.2 < ate < 0.6


def test_metrics_perfect_ranking(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.3), (0, 0.1)], "failure_next_3d int, score double")
    m = failure.classification_metrics(df).first()
    assert m.roc_auc == 1.0 and m.average_precision == 1.0 and m.f1 == 1.0


def test_stratified_split_exact_share(spark):
    rows = [(i, i % 10 == 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, y boolean").withColumn("y", F.col("y").cast("int"))
    s = failure.stratified_split(df, "y", ["id"], 0.2)
    c = {(r.split, r.y): r["count"] for r in s.groupBy("split", "y").count().collect()}
    assert c[("test", 1)] == 20 and c[("test", 0)] == 180


def test_itemsets_equal_brute_force(spark):
    import itertools
    from collections import Counter

    rng = np.random.default_rng(11)
    rows, want = [], Counter()
    for i in range(60):
        items = sorted({f"c{int(x):02d}" for x in rng.geometric(0.2, 8)})
        n = int(rng.integers(1, 4))
        rows.append((i, items, n))
        for k in (1, 2, 3, 4):
            want.update({s: n for s in itertools.combinations(items, k)})
    total = sum(r[2] for r in rows)
    t = spark.createDataFrame(rows, "basket long, items array<string>, n long")
    for size in (1, 2, 3, 4):
        got = {tuple(r["items"]): r["count"] for r in patterns.itemsets(t, 0.1, size).collect()}
        assert got == {s: c for s, c in want.items() if len(s) <= size and c / total >= 0.1}
    assert patterns.itemsets(t.limit(0), 0.1, 3).count() == 0


def test_itemsets_of_wide_baskets_stay_small(spark):
    """Sixteen codes in every basket have 65,535 frequent sets, 696 of up to three items."""
    t = spark.createDataFrame([(0, [f"c{i:02d}" for i in range(16)], 12)], "basket long, items array<string>, n long")
    assert patterns.itemsets(t, 0.05, 3).count() == 16 + 120 + 560


def test_dashboard_document(spark):
    import json

    from turnstile.operators import scoring

    rows = [("b", "x\"y", "m", 1.25), ("b", "a", "m", 2.0), ("b", "a", "k", None), ("a", "", "n", 0.00004), ("a", "", "w", float("nan")), ("c", "[i]", "m", -3.5)]
    df = spark.createDataFrame(rows, "block string, item string, metric string, value double").repartition(3)
    text = scoring.dashboard_document(df).first().document
    assert json.loads(text) == {"a": {"all": {"n": 0.0, "w": None}}, "b": {"a": {"k": None, "m": 2.0}, "x\"y": {"m": 1.25}}, "c": {"[i]": {"m": -3.5}}}
    assert list(json.loads(text)) == ["a", "b", "c"]
    assert scoring.dashboard_document(df.limit(0)).first().document == "{}"
