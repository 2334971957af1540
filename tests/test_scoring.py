"""Forest, importances, champion and the scoring queries against their definitions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from turnstile.operators import drift as dr
from turnstile.operators import failure as fm


def planted(spark, n=900, seed=5):
    """Failures follow error_count and one maker; the other inputs are noise."""
    rng = np.random.default_rng(seed)
    errors, noise, maker = rng.integers(0, 20, n), rng.normal(size=n), rng.choice(["A", "B", "C"], n)
    y = ((errors > 11) | ((maker == "B") & (errors > 7))).astype(int)
    y = np.where(rng.random(n) < 0.03, 1 - y, y)
    rows = [(i, int(e), float(z), str(m), int(t)) for i, (e, z, m, t) in enumerate(zip(errors, noise, maker, y))]
    return spark.createDataFrame(rows, f"device_id int, error_count int, temperature_c double, manufacturer string, {fm.TARGET} int")


def auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


@pytest.fixture(scope="module")
def forest(spark):
    df = planted(spark)
    train = fm.class_weights(df.where("device_id % 3 <> 0"), fm.TARGET)
    return fm.train(train, "random_forest", ["error_count", "temperature_c"], ["manufacturer"]), df


def test_forest_on_held_out_rows(spark, forest):
    (model, _), df = forest
    scored = fm.predict(model, df.where("device_id % 3 = 0"))
    pairs = [(r[fm.TARGET], r.score) for r in scored.collect()]
    m = fm.classification_metrics(scored).first()
    assert m.roc_auc > 0.93 and math.isclose(m.roc_auc, auc(pairs), rel_tol=1e-9)
    assert m.tp == sum(y and s >= 0.5 for y, s in pairs) and m.tn == sum((not y) and s < 0.5 for y, s in pairs)


def test_forest_rows_keep_their_nodes(spark, forest, monkeypatch):
    """The forest whose rows don't walk down all trees at every level is the same forest."""
    (model, _), df = forest
    assert model.stages[-1].getCacheNodeIds()
    classifier = fm.RandomForestClassifier
    monkeypatch.setattr(fm, "RandomForestClassifier", lambda **settings: classifier(**(settings | {"cacheNodeIds": False})))
    train = fm.class_weights(df.where("device_id % 3 <> 0"), fm.TARGET)
    walked, _ = fm.train(train, "random_forest", ["error_count", "temperature_c"], ["manufacturer"])
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees] for m in (walked, model)]  # the first line names the object
    assert len(trees[0]) == 200 and trees[0] == trees[1]


def test_importance_finds_what_matters(forest):
    (model, inputs), _ = forest
    pairs = fm.feature_importance(model, inputs, 2)
    assert len(pairs) == 2 and pairs[0][0] == "error_count" and pairs[0][1] > 0.6 and pairs[0][1] >= pairs[1][1]
    assert math.isclose(sum(v for _, v in fm.feature_importance(model, inputs, 99)), 1.0, abs_tol=1e-9)


def test_scoring_queries_agree(spark):
    q = E.queries()
    metrics = [q[k](spark, SF_SMALL).first() for k in ("m2_random_forest", "m3_gradient_boosting", "m4_boosting_categorical")]
    best = max(metrics, key=lambda r: (r.roc_auc, r.model))
    champion = q["m7_champion"](spark, SF_SMALL).first()
    assert (champion.champion, champion.roc_auc) == (best.model, best.roc_auc)
    devices = {r[0] for r in q["m31_rul"](spark, SF_SMALL).select("device_id").collect()}
    batch = q["m9_batch_scoring"](spark, SF_SMALL).collect()
    assert {r.device_id for r in batch} == devices and len(batch) == len(devices)
    for r in batch:
        if abs(r.failure_probability - 0.4) > 1e-4:
            assert r.high_risk == (r.failure_probability >= 0.4)
    combined = {r.device_id: r for r in q["m10_combined_scoring"](spark, SF_SMALL).collect()}
    assert combined.keys() == devices
    scores = {r.device_id: r for r in batch}
    assert all((c.failure_probability, c.failure_tier) == (scores[d].failure_probability, scores[d].risk_tier) for d, c in combined.items())
    last = {}
    for r in q["m22_isolation_forest"](spark, SF_SMALL).collect():
        if r.device_id not in last or r.date > last[r.device_id].date:
            last[r.device_id] = r
    assert all(c.anomaly_label == last[d].anomaly_label for d, c in combined.items())
    importance = q["m8_feature_importance"](spark, SF_SMALL).collect()
    values = [r.importance for r in importance]
    assert len(values) == 15 and values == sorted(values, reverse=True) and 0 < sum(values) <= 1 + 1e-6


def test_models_share_the_training_rows(spark, monkeypatch):
    """The three fits read one kept table, which is dropped after them."""
    from turnstile.plans import q_ml
    from turnstile.sources.canonical import Fleet

    monkeypatch.setattr(Fleet, "_cache", {})
    given, levels = [], []

    def train(rows, name):
        given.append(rows)
        levels.append(rows.storageLevel.useMemory)
        return name, ["error_count"]

    monkeypatch.setattr(fm, "train", train)
    monkeypatch.setattr(fm, "predict", lambda model, df: df.withColumn("score", F.lit(0.5)))
    made = q_ml._all_metrics(spark, SF_SMALL).collect()
    assert [r.model for r in made] == q_ml.MODELS and len(given) == 3 and levels == [True] * 3
    assert all(rows is given[0] for rows in given) and not given[0].storageLevel.useMemory


def test_decision_matrix(spark):
    want = {(0.51, 0.95): "Emergency retrain + alert team", (0.5, 0.84): "Urgent retrain + root cause", (0.31, 0.85): "Retrain (proactive)",
            (0.3, 0.84): "Investigate features, retrain", (0.0, 0.2): "Investigate features, retrain", (0.3, 0.85): "Monitor, retrain next month",
            (0.1, 0.99): "Monitor, retrain next month", (0.09, 0.91): "Do nothing", (0.09, 0.9): "Monitor", (0.0, 0.85): "Monitor"}
    df = spark.createDataFrame(list(want), "drift_share double, auc double")
    assert {(r.drift_share, r.auc): r.action for r in dr.decision_matrix(df).collect()} == want
