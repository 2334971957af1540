"""Shapley values of tree ensembles.

For every row and feature: the feature's Shapley value in the game where a set of known features is worth the expected model output, a tree
being followed to both children, by their shares of training rows, where the split's feature isn't known.  The values and the expected output add up to
the model's output exactly: class-1 probability for forests, log-odds margin for boosted trees.

A leaf's share of a value depends only on which of the d distinct features on its path the row satisfies (their splits joined to one interval or set each).
For such a pattern o and the shares z of training rows that satisfy each feature's splits, with value v at the leaf:

    phi_j = v (o_j - z_j) sum_s  s! (d - 1 - s)! / d!  [y^s] prod_{k != j} (z_k + o_k y)

So a leaf needs one small table over its patterns: over all 2^d for up to ``TABLE_FEATURES`` features, made once a task, over
those that a batch of rows has on longer paths.  Rows are scored in ``mapInArrow``, all of them, no sampling; trees are sent
to the tasks (bounded by the model: trees x nodes).
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.operators.boosting import Booster
from turnstile.operators.failure import BoostedModel, sized
from turnstile.session import scratch_path

TABLE_FEATURES = 6


class Nodes(NamedTuple):
    """A tree, root first: ``feat`` is -1 at leaves; left where the value is <= ``thr``, or in the set ``cats`` if there is one.

    ``value``: what a leaf adds to the output; ``cover``: training rows (or their weight) at each node."""

    feat: np.ndarray
    thr: np.ndarray
    cats: list
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


class Leaf(NamedTuple):
    """A path: its distinct features, what each must satisfy, the share of training rows that do, and the leaf's value."""

    feats: np.ndarray
    tests: list
    z: np.ndarray
    value: float


def forest_of_spark(spark, ensemble) -> tuple[list[Nodes], float]:
    """Trees of a Spark forest of two classes, from its saved form."""
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    ensemble.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").collect()  # trees x nodes: bounded by the model size
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    out = []
    for some in by_tree.values():
        some.sort(key=lambda r: r["id"])
        place = {r["id"]: i for i, r in enumerate(some)}
        inner = [r["leftChild"] >= 0 for r in some]
        cover = np.array([sum(r["impurityStats"]) for r in some])
        positive = np.array([r["impurityStats"][1] if len(r["impurityStats"]) > 1 else 0.0 for r in some])
        out.append(Nodes(
            np.array([r["featureIndex"] if i else -1 for r, i in zip(some, inner)]),
            np.array([r["leftCategoriesOrThreshold"][0] if i and r["numCategories"] == -1 else 0.0 for r, i in zip(some, inner)]),
            [frozenset(r["leftCategoriesOrThreshold"]) if i and r["numCategories"] != -1 else None for r, i in zip(some, inner)],
            np.array([place.get(r["leftChild"], -1) for r in some]), np.array([place.get(r["rightChild"], -1) for r in some]),
            positive / np.maximum(cover, 1e-300) / len(by_tree), cover))
    return out, 0.0


def forest_of_booster(model: Booster) -> tuple[list[Nodes], float]:
    return [Nodes(t.feat, t.thr, [None] * len(t.feat), t.left, t.right, t.value, c) for t, c in zip(model.trees, model.covers)], model.base


def leaves(t: Nodes) -> list[Leaf]:
    """All paths that training rows reach."""
    out = []
    todo = [(0, {}, {})]
    while todo:
        i, tests, z = todo.pop()
        if t.feat[i] < 0:
            feats = sorted(tests)
            out.append(Leaf(np.array(feats, np.int64), [tests[f] for f in feats], np.array([z[f] for f in feats]), float(t.value[i])))
            continue
        f = int(t.feat[i])
        for child, on_left in ((t.left[i], True), (t.right[i], False)):
            low, high, inside, outside = tests.get(f, (None, None, (), ()))
            if t.cats[i] is not None:
                inside, outside = (inside + (t.cats[i],), outside) if on_left else (inside, outside + (t.cats[i],))
            elif on_left:
                high = float(t.thr[i]) if high is None else min(high, float(t.thr[i]))
            else:
                low = float(t.thr[i]) if low is None else max(low, float(t.thr[i]))
            if t.cover[child] > 0:
                todo.append((int(child), tests | {f: (low, high, inside, outside)}, z | {f: z.get(f, 1.0) * t.cover[child] / t.cover[i]}))
    return out


def satisfied(test: tuple, x: np.ndarray) -> np.ndarray:
    low, high, inside, outside = test
    on = np.ones(len(x), bool)
    if high is not None:
        on &= x <= high
    if low is not None:
        on &= ~(x <= low)
    for some in inside:
        on &= np.isin(x, list(some))
    for some in outside:
        on &= ~np.isin(x, list(some))
    return on


def expected(t: Nodes) -> float:
    """The mean of the leaves' values over training rows."""
    leaf = t.feat < 0
    return float((t.value[leaf] * t.cover[leaf]).sum() / t.cover[0])


def shapley_weights(o: np.ndarray, z: np.ndarray) -> np.ndarray:
    """phi / v of each feature for rows of patterns ``o`` (0 or 1) and shares ``z``, both of shape (rows, features)."""
    m, d = o.shape
    c = np.zeros((d + 1, m))
    c[0] = 1
    for k in range(d):  # times (z_k + o_k y)
        c[1:] = c[1:] * z[:, k] + c[:-1] * o[:, k]
        c[0] *= z[:, k]
    share = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
    out = np.empty((m, d))
    for j in range(d):  # divided by (z_j + o_j y): from the top if o_j is 1, by z_j if not
        on = o[:, j] > 0
        top, rest, total = np.zeros(m), 1 / np.where(on, 1, z[:, j]), np.zeros(m)
        for s in range(d - 1, -1, -1):
            top = c[s + 1] - z[:, j] * top
            total += share[s] * np.where(on, top, c[s] * rest)
        out[:, j] = total * (o[:, j] - z[:, j])
    return out


def _distinct(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different codes below ``size``, and the place of each row's among them."""
    if size > 1 << 16:
        return np.unique(code, return_inverse=True)
    found = np.flatnonzero(np.bincount(code, minlength=size))
    place = np.empty(size, np.int64)
    place[found] = np.arange(len(found))
    return found, place[code]


class Explainer:
    """Shapley values of batches of rows; keeps the tables of short paths."""

    def __init__(self, forest: list[Nodes], base: float):
        self.trees = [leaves(t) for t in forest]
        self.base = base + sum(expected(t) for t in forest)
        self.start = base
        self._tables: dict[tuple[int, int], np.ndarray] = {}

    def explain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values by feature and row, output by row) of ``x``, features first."""
        out, output = np.zeros(x.shape), np.full(x.shape[1], self.start)
        value = np.empty(x.shape[1])
        for number, tree in enumerate(self.trees):
            asked: dict[int, list] = {}
            known: dict[tuple, np.ndarray] = {}  # paths of a tree share most of their tests
            for at, leaf in enumerate(tree):
                d = len(leaf.feats)
                feats = leaf.feats.tolist()
                code = np.zeros(x.shape[1], np.int64 if d > 16 else np.uint16)
                for k, (f, test) in enumerate(zip(feats, leaf.tests)):
                    if (f, test) not in known:
                        known[f, test] = satisfied(test, x[f])
                    code |= np.left_shift(known[f, test], k, dtype=code.dtype)
                output[code == (1 << d) - 1] += leaf.value
                code = code.astype(np.int64)
                if 0 < d <= TABLE_FEATURES:
                    if (number, at) not in self._tables:
                        o = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
                        self._tables[number, at] = (leaf.value * shapley_weights(o, np.broadcast_to(leaf.z, o.shape))).T.copy()
                    for f, table in zip(feats, self._tables[number, at]):
                        out[f] += table.take(code, out=value, mode="clip")
                elif d:
                    asked.setdefault(d, []).append((leaf, *_distinct(code, 1 << d)))
            for d, some in asked.items():  # paths of one length together
                o = (np.concatenate([codes for _, codes, _ in some])[:, None] >> np.arange(d)) & 1
                z = np.concatenate([np.broadcast_to(leaf.z, (len(codes), d)) for leaf, codes, _ in some])
                made = np.split(shapley_weights(o, z).T, np.cumsum([len(codes) for _, codes, _ in some])[:-1], axis=1)
                for (leaf, _, row), phi in zip(some, made):
                    out[leaf.feats] += leaf.value * phi[:, row]
        return out, output


def attributions(model, df: DataFrame, key_cols: list[str], inputs: list[str]) -> DataFrame:
    """Rows: keys, ``base`` (the expected output), ``output`` (the model's value), ``attr`` array in ``inputs`` order."""
    spark = df.sparkSession
    if isinstance(model, BoostedModel):
        prep, (forest, start) = model.encode(df), forest_of_booster(model.booster)
    else:
        prep = df
        for stage in model.stages[:-2]:  # the assembler only puts the inputs in order
            prep = stage.transform(prep)
        forest, start = forest_of_spark(spark, model.stages[-1])
    sent = spark.sparkContext.broadcast((forest, start))  # trees x nodes: bounded by the model
    # the table may lie in fewer files than there are cores
    rows = sized(prep, 100_000, 1_000).select(*key_cols, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([rows.schema[c] for c in key_cols] + [
        T.StructField("base", T.DoubleType()), T.StructField("output", T.DoubleType()), T.StructField("attr", T.ArrayType(T.DoubleType()))])
    n_keys, p = len(key_cols), len(inputs)

    def run(batches):
        explainer = Explainer(*sent.value)
        for batch in batches:
            n = batch.num_rows
            x = np.stack([batch.column(n_keys + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(p)])
            values, output = explainer.explain(x)
            attr = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * p, pa.int32()), pa.array(values.T.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], pa.array(np.full(n, explainer.base)), pa.array(output), attr], names=schema.names)

    return rows.mapInArrow(run, schema)


def global_importance(attr: DataFrame, inputs: list[str]) -> DataFrame:
    """Mean |Shapley value| per feature over all rows (one aggregation)."""
    one = attr.agg(*[F.avg(F.abs(F.col("attr")[i])).alias(f"f{i}") for i in range(len(inputs))])
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"f{i}").alias("mean_abs_attribution"))
            for i, n in enumerate(inputs)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def local_explanation(attr: DataFrame, inputs: list[str], top: int = 5) -> DataFrame:
    """The row with the highest model output, its top features by |Shapley value|."""
    worst = attr.agg(F.max_by(F.struct(*attr.columns), F.col("output")).alias("w")).select("w.*")
    rows = [F.struct(F.lit(n).alias("feature"), F.col("attr")[i].alias("attribution")) for i, n in enumerate(inputs)]
    long = worst.select(*[c for c in worst.columns if c not in ("attr",)], F.explode(F.array(*rows)).alias("r")) \
        .select(*[c for c in worst.columns if c not in ("attr",)], "r.*")
    return long.orderBy(F.abs("attribution").desc(), "feature").limit(top)


def dependence(attr: DataFrame, df: DataFrame, key_cols: list[str], feature: str, inputs: list[str]) -> DataFrame:
    """Feature value vs its Shapley value for every row; encoded inputs (``<column>__idx``, ``<column>__mean``) show the column's value."""
    column = feature if feature in df.columns else feature.rsplit("__", 1)[0]
    at = next(i for i, name in enumerate(inputs) if name == feature or name.rsplit("__", 1)[0] == feature)
    return attr.select(*key_cols, F.col("attr")[at].alias("attribution")).join(
        df.select(*key_cols, F.col(column).cast("string").alias("value") if column != feature else F.col(column).alias("value")), key_cols)


def attribution_drift(attr: DataFrame, inputs: list[str], date_col: str = "date") -> DataFrame:
    """Mean |Shapley value| per feature and week, with the change from the previous week."""
    wk = attr.withColumn("week", F.date_trunc("week", F.col(date_col)).cast("date"))
    one = wk.groupBy("week").agg(*[F.avg(F.abs(F.col("attr")[i])).alias(f"f{i}") for i in range(len(inputs))])
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"f{i}").alias("importance")) for i, n in enumerate(inputs)]
    long = one.select("week", F.explode(F.array(*rows)).alias("r")).select("week", "r.*")
    w = Window.partitionBy("feature").orderBy("week")  # one row per week per feature
    r = long.withColumn("rank", F.rank().over(Window.partitionBy("week").orderBy(F.col("importance").desc())))
    return r.withColumn("change", F.col("importance") - F.lag("importance").over(w))
