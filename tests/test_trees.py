"""Boosting against a plain greedy fit, ordered target means, and Shapley values against sums over feature subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from turnstile.operators import attribution, boosting, failure


def frame(spark, n=200, seed=2, nulls=True):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 4)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 3) | (rng.random(n) < 0.15)).astype(int)
    w = rng.integers(1, 4, n).astype(float)
    rows = [(int(i), *[None if nulls and rng.random() < 0.05 else float(v) for v in r], int(t), float(u)) for i, (r, t, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int, w double"), rows


def plain_boosting(rows, rounds, depth, rate, l2, min_child, symmetric):
    """Margins of the rows by trying every split of every node in turn."""
    x = np.array([[np.nan if v is None else v for v in r[1:5]] for r in rows])
    y, w = np.array([r[5] for r in rows], float), np.array([r[6] for r in rows])
    mean = (y * w).sum() / w.sum()
    margin = np.full(len(rows), math.log(mean / (1 - mean)))
    cuts = [(j, t) for j in range(4) for t in sorted({v for v in x[:, j] if v == v})[:-1]]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        nodes, done = [np.arange(len(rows))], []

        def gain(node, j, t):
            left = x[node, j] <= t
            gl, hl, ga, ha = g[node][left].sum(), h[node][left].sum(), g[node].sum(), h[node].sum()
            if not symmetric and (hl < min_child or ha - hl < min_child):
                return -np.inf
            return gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2)

        for _ in range(depth):
            following = []
            shared = max(((sum(gain(n, j, t) for n in nodes), -i) for i, (j, t) in enumerate(cuts))) if symmetric else None
            for node in nodes:
                best, i = shared if symmetric else max((gain(node, j, t), -i) for i, (j, t) in enumerate(cuts))
                if best <= 1e-9:
                    done.append(node)
                    continue
                j, t = cuts[-i]
                left = x[node, j] <= t
                following += [node[left], node[~left]]
            nodes = following
        for node in done + nodes:
            margin[node] += -rate * g[node].sum() / (h[node].sum() + l2)
    return margin


@pytest.mark.parametrize("symmetric", [False, True])
def test_boosting_equals_plain_fit(spark, monkeypatch, symmetric):
    df, rows = frame(spark)
    settings = {"rounds": 10, "depth": 3, "rate": 0.3, "l2": 1.5, "min_child": 2.0, "symmetric": symmetric}
    one = boosting.fit(df, ["a", "b", "c", "d"], "y", "w", **settings)
    want = plain_boosting(rows, **settings)
    got = {r.id: r.score for r in one.score(df).select("id", "score").collect()}
    assert len(one.trees) == 10
    assert np.allclose([got[r[0]] for r in rows], 1 / (1 + np.exp(-want)), atol=1e-9)
    monkeypatch.setattr(boosting, "ONE_TASK", 0)  # a job for every level, margins refreshed on the way
    spread = boosting.fit(df.repartition(3), ["a", "b", "c", "d"], "y", "w", **settings)
    assert all((a.feat == b.feat).all() and np.allclose(a.value, b.value) for a, b in zip(one.trees, spread.trees))
    assert all((a == b).all() for a, b in zip(one.covers, spread.covers)) and one.covers[0][0] == len(rows)


@pytest.mark.parametrize("symmetric", [False, True])
def test_only_chosen_splits_reach_the_driver(spark, monkeypatch, symmetric):
    """What a level's job returns doesn't grow with the bins or the partitions; equal features are split at the first."""
    df, _ = frame(spark, nulls=False)
    df = df.withColumn("e", F.col("a"))
    inputs, settings = ["a", "b", "c", "d", "e"], {"rounds": 5, "depth": 3, "symmetric": symmetric}
    one = boosting.fit(df, inputs, "y", "w", **settings)
    monkeypatch.setattr(boosting, "ONE_TASK", 0)
    fetched, first_best = [], boosting._first_best

    def seen(groups):
        fetched.append(max(g.size for g in groups))
        return first_best(groups)

    monkeypatch.setattr(boosting, "_first_best", seen)
    spread = boosting.fit(df.repartition(7), inputs, "y", "w", **settings)
    assert len(fetched) == 15 and max(fetched) <= 7 * 4
    assert all((a.feat == b.feat).all() and (a.bin == b.bin).all() for a, b in zip(one.trees, spread.trees))
    assert all(4 not in t.feat for t in spread.trees) and any(0 in t.feat for t in spread.trees)


@pytest.mark.parametrize("symmetric", [False, True])
def test_features_are_added_up_in_groups(spark, monkeypatch, symmetric):
    """A larger table's task: the trees of plain sums, ties at the first of equal features, and of two children only the smaller one's rows are added up."""
    df, rows = frame(spark, n=500)
    df = df.withColumn("e", F.col("a")).withColumn("f", F.col("b") * 2 + 1)
    inputs, settings = ["a", "b", "c", "d", "e", "f"], {"rounds": 6, "depth": 4, "rate": 0.3, "l2": 1.5, "symmetric": symmetric}
    plain = boosting.fit(df, inputs, "y", "w", **settings)
    monkeypatch.setattr(boosting, "PLAIN", 0)
    joint = boosting.fit(df.repartition(3), inputs, "y", "w", **settings)
    assert len(joint.trees) == 6 and all((t.feat < 4).all() for t in joint.trees)
    assert all((a.bin == b.bin).all() and (a.feat % 4 == b.feat % 4).all() and np.allclose(a.value, b.value, atol=1e-9) for a, b in zip(plain.trees, joint.trees))
    assert all((a == b).all() for a, b in zip(plain.covers, joint.covers)) and joint.covers[0][0] == 500

    edges = boosting._edges(df, inputs, 64)
    made = boosting._Joint(boosting._blocks(df, inputs, edges, "y", "w").collect(), edges)
    assert len(made.groups) == 2 and sorted(j for group in made.groups for j in group) == list(range(6))
    added, whole = [], made._added

    def seen(nodes, size, bins):
        added.append(sum(made._rows_of(nodes, size)))
        return whole(nodes, size, bins)

    monkeypatch.setattr(made, "_added", seen)
    boosting._boost(made, inputs, edges, {**settings, "rounds": 1, "min_child": 1.0})
    assert added[0] == 500 and len(added) == 4 and max(added[1:]) <= 250


def test_quantiles_of_some_features_a_query(spark, monkeypatch):
    df, _ = frame(spark)
    asked, percentile = [], F.percentile_approx
    monkeypatch.setattr(boosting, "EDGES_AT_ONCE", 3)
    monkeypatch.setattr(boosting.F, "percentile_approx", lambda *args: asked.append(args) or percentile(*args))
    some = boosting._edges(df, ["a", "b", "c", "d"], 8)
    monkeypatch.setattr(boosting, "EDGES_AT_ONCE", 9)
    assert len(asked) == 4 and all((a == b).all() for a, b in zip(some, boosting._edges(df, ["a", "b", "c", "d"], 8), strict=True))


def test_blocks_join_batches(spark):
    df, _ = frame(spark)
    edges = boosting._edges(df, ["a", "b"], 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        blocks = boosting._blocks(df.coalesce(1), ["a", "b"], edges, "y", "w").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [b[0].shape for b in blocks] == [(2, 200)] and blocks[0][2].sum() == df.agg(F.sum("w")).first()[0]


def test_partitions_are_bounded_by_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert failure.sized(spark.range(1_000_000)).rdd.getNumPartitions() == cores
    assert failure.sized(spark.range(1_000), 100, 1_000).rdd.getNumPartitions() == 10


def test_long_tasks_beside_keep_their_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(1_000_000)
    assert failure.sized(df, others=2).rdd.getNumPartitions() == cores - 2 and failure.sized(df, others=99).rdd.getNumPartitions() == 1
    assert failure.sized(df, counted=spark.range(9_000)).rdd.getNumPartitions() == 2 and failure.sized(spark.range(9_000), others=2).rdd.getNumPartitions() == 2


def test_rows_are_explained_on_all_cores(spark):
    df, _ = frame(spark, n=4000)
    model = failure.BoostedModel(lambda d: d, boosting.fit(df, ["a", "b", "c", "d"], "y", "w", rounds=2, depth=2))
    made = attribution.attributions(model, df.coalesce(1), ["id"], ["a", "b", "c", "d"])
    assert made.rdd.getNumPartitions() == min(4, spark.sparkContext.defaultParallelism) and made.count() == 4000


def test_rows_are_scored_once_for_metrics(spark):
    calls = spark.sparkContext.accumulator(0)

    def score(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    rows = [(i % 2, (i * 7 % 50) / 50) for i in range(100)]
    df = spark.createDataFrame(rows, f"{failure.TARGET} int, score double")
    assert failure.classification_metrics(df.mapInArrow(score, df.schema)).count() == 1
    assert calls.value == 100


def test_boosting_of_one_class_and_constant_inputs(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (None, 0)], "a double, y int")
    model = boosting.fit(df, ["a"], "y", rounds=3)
    assert model.trees == [] and all(r.score < 1e-5 for r in model.score(df).collect())


def test_ordered_targets(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), None if i % 17 == 0 else f"c{int(rng.integers(0, 5))}", int(rng.integers(0, 2))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, y int")
    made = boosting.OrderedTargets(["c"], "y", ["id"])
    got = {r.id: r["c__mean"] for r in made.fit(df).collect()}
    order = {r.id: r.h for r in df.select("id", F.shiftrightunsigned(F.xxhash64("id", F.lit(42)), 11).alias("h")).collect()}
    prior = np.mean([r[2] for r in rows])
    for i, c, _ in rows:
        before = [t for k, v, t in rows if v == c and order[k] < order[i]]
        assert math.isclose(got[i], (sum(before) + prior) / (len(before) + 1))
    other = made.transform(spark.createDataFrame([(1, "c1"), (2, "new"), (3, None)], "id long, c string")).orderBy("id").collect()
    for (_, c), r in zip([(1, "c1"), (2, "new"), (3, None)], other):
        some = [t for _, v, t in rows if v == c]
        assert math.isclose(r["c__mean"], (sum(some) + prior) / (len(some) + 1) if some else prior)


def test_rows_with_target_means_are_made_once(spark, monkeypatch):
    """The table that the edges and then the blocks are read from is kept for the fit, and no longer."""
    df, _ = frame(spark, nulls=False)
    train = failure.class_weights(df.select(F.col("id").alias("device_id"), F.lit(0).alias("date"), F.col("a").alias("error_count"),
                                            F.col("b").cast("string").alias("manufacturer"), F.col("y").alias(failure.TARGET)), failure.TARGET)
    given, fit = [], boosting.fit

    def seen(rows, *args, **settings):
        given.append((rows, rows.storageLevel.useMemory))
        return fit(rows, *args, **(settings | {"rounds": 2}))

    monkeypatch.setattr(boosting, "fit", seen)
    model, inputs = failure.train(train, "boosting_categorical", ["error_count"], ["manufacturer"])
    (rows, kept), = given
    assert kept and not rows.storageLevel.useMemory
    assert inputs == ["error_count", "manufacturer__mean"] and len(model.booster.trees) == 2 and model.booster.covers[0][0] == 200


def test_categories_help(spark):
    """Forty categories whose effect has no order: the ordered means find it, numbers in alphabetical order hardly."""
    rng = np.random.default_rng(5)
    effect = rng.random(40) > 0.5
    rows = [(int(i), "2024-01-01", f"m{int(c):02d}", float(rng.normal()), int(rng.random() < (0.85 if effect[c] else 0.15))) for i, c in enumerate(rng.integers(0, 40, 3000))]
    df = spark.createDataFrame(rows, f"device_id long, date string, manufacturer string, temperature_c double, {failure.TARGET} int")
    train, test = df.where("device_id < 2000"), df.where("device_id >= 2000")
    train = failure.class_weights(train, failure.TARGET)

    def auc(name, categorical):
        model, _ = failure.train(train, name, ["temperature_c"], categorical)
        return failure.classification_metrics(failure.predict(model, test)).first()["roc_auc"]

    with_category, without = auc("boosting_categorical", ["manufacturer"]), auc("boosting_categorical", [])
    assert with_category > 0.8 and without < 0.6
    assert with_category != auc("gradient_boosting", ["manufacturer"])


def conditional(t, x, known, i=0):
    if t.feat[i] < 0:
        return t.value[i]
    f = t.feat[i]
    if f in known:
        left = x[f] in t.cats[i] if t.cats[i] is not None else x[f] <= t.thr[i]
        return conditional(t, x, known, t.left[i] if left else t.right[i])
    return sum(t.cover[c] / t.cover[i] * conditional(t, x, known, c) for c in (t.left[i], t.right[i]) if t.cover[c] > 0)


def subset_shapley(forest, x):
    p = len(x)
    worth = {s: sum(conditional(t, x, s) for t in forest) for n in range(p + 1) for s in itertools.combinations(range(p), n)}
    out = np.zeros(p)
    for j in range(p):
        for s, v in worth.items():
            if j not in s:
                both = tuple(sorted((*s, j)))
                out[j] += math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p) * (worth[both] - v)
    return out


@pytest.mark.parametrize("tables", [6, 0])
def test_shapley_of_boosting(spark, monkeypatch, tables):
    monkeypatch.setattr(attribution, "TABLE_FEATURES", tables)
    df, rows = frame(spark)
    model = boosting.fit(df, ["a", "b", "c", "d"], "y", "w", rounds=6, depth=4)
    forest, base = attribution.forest_of_booster(model)
    x = np.array([[np.nan if v is None else v for v in r[1:5]] for r in rows[:25]]).T
    explainer = attribution.Explainer(forest, base)
    values, output = explainer.explain(x)
    assert np.allclose(output, model.margins(x)) and np.allclose(explainer.base + values.sum(axis=0), output)
    for k in range(25):
        assert np.allclose(values[:, k], subset_shapley(forest, x[:, k]))


def test_shapley_of_short_and_long_paths_together(spark, monkeypatch):
    monkeypatch.setattr(attribution, "TABLE_FEATURES", 2)
    df, rows = frame(spark)
    forest, base = attribution.forest_of_booster(boosting.fit(df, ["a", "b", "c", "d"], "y", "w", rounds=6, depth=4))
    explainer = attribution.Explainer(forest, base)
    assert {len(leaf.feats) > 2 for t in explainer.trees for leaf in t} == {True, False}
    tested, satisfied = [], attribution.satisfied
    monkeypatch.setattr(attribution, "satisfied", lambda test, x: tested.append(test) or satisfied(test, x))
    x = np.array([[np.nan if v is None else v for v in r[1:5]] for r in rows[:25]]).T
    values, _ = explainer.explain(x)
    assert len(tested) < sum(len(leaf.feats) for t in explainer.trees for leaf in t)  # once for all paths of a tree
    for k in range(25):
        assert np.allclose(values[:, k], subset_shapley(forest, x[:, k]))


def test_shapley_of_forest(spark):
    df, _ = frame(spark, nulls=False)
    df = df.withColumn("k", (F.col("id") % 5).cast("double")).withColumn("y", F.when(F.col("k").isin(1.0, 4.0), 1 - F.col("y")).otherwise(F.col("y")))
    inputs = ["a", "b", "k__idx", "d"]
    from pyspark.ml.feature import StringIndexer

    stages = [StringIndexer(inputCol="k", outputCol="k__idx", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=inputs, outputCol="features"),
              RandomForestClassifier(labelCol="y", numTrees=8, maxDepth=6, seed=1)]
    model = Pipeline(stages=stages).fit(df)
    got = attribution.attributions(model, df, ["id"], inputs).orderBy("id").collect()
    scored = {r.id: r for r in failure.predict(model, df).collect()}
    forest, _ = attribution.forest_of_spark(spark, model.stages[-1])
    assert any(c is not None for t in forest for c in t.cats)
    for r in got:
        assert math.isclose(r.output, scored[r.id].score, abs_tol=1e-9) and math.isclose(r.base + sum(r.attr), r.output, abs_tol=1e-9)
    for r in got[:20]:
        assert np.allclose(r.attr, subset_shapley(forest, [scored[r.id][c] for c in inputs]))
