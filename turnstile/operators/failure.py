"""Failure prediction (M1-M10, A17, W16): split, train, evaluate, pick a champion, score.

The forest is Spark ML's; the two boosted models grow over binned features (``boosting``).  Evaluation metrics are
aggregations over (label, score) pairs pre-aggregated to distinct scores, with
running sums from bucketed prefix sums, so no window spans the prediction set.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.exprs import failure_tier_batch
from turnstile.functions.stats import bucketed_prefix_sums, value_at_rank
from turnstile.operators import boosting
from turnstile.session import materialize

# Model inputs (same names as the feature store's failure set).
NUMERIC_FEATURES = [
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
]
CATEGORICAL_FEATURES = [
    "manufacturer", "firmware_version", "gate_type",
    "is_old_device", "is_beta_firmware", "is_under_warranty",
    "is_high_traffic_station",
]
TARGET = "failure_next_3d"


# ---------------------------------------------------------------- M1
def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Deterministic stratified split: per label value, the ``ceil(test_size * n)`` rows
    with the smallest seeded hash form the test set (exact count, found by the
    distributed rank selection, no per-label sort in one task)."""
    import math

    h = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed)), 11).cast("double")
    x = df.withColumn("_h", h)
    counts = {r[0]: r[1] for r in x.groupBy(label).count().collect()}  # one row per label value
    cond = F.lit(False)
    for lab, n in counts.items():
        k = math.ceil(test_size * n)
        if k == 0:
            continue
        thr = value_at_rank(x.where(F.col(label) == lab), "_h", k - 1, n)
        cond = cond | ((F.col(label) == lab) & (F.col("_h") <= F.lit(thr)))
    return x.withColumn("split", F.when(cond, "test").otherwise("train")).drop("_h")


# ---------------------------------------------------------------- A17
def class_weights(df: DataFrame, label: str) -> DataFrame:
    """'balanced' weights n / (2 * n_c) per class, and scale_pos_weight = neg / max(pos, 1)."""
    c = df.groupBy(label).count().collect()  # two rows
    n = sum(r["count"] for r in c)
    k = max(len(c), 1)
    w = {r[label]: n / (k * r["count"]) for r in c}
    neg = next((r["count"] for r in c if r[label] == 0), 0)
    pos = next((r["count"] for r in c if r[label] == 1), 0)
    expr = F.lit(1.0)
    for lab, v in w.items():
        expr = F.when(F.col(label) == lab, F.lit(v)).otherwise(expr)
    scale = F.lit(neg / max(pos, 1))
    return (df.withColumn("class_weight", expr).withColumn("scale_pos_weight", scale)
              .withColumn("positive_weight", F.when(F.col(label) == 1, scale).otherwise(F.lit(1.0))))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    tot = df.count()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).withColumn("share", F.col("rows") / F.lit(tot))


# ---------------------------------------------------------------- M2-M4
def _indexers(df: DataFrame, numeric, categorical):
    """Stages that number the text categories in alphabetical order, and the names of all inputs."""
    text = [c for c in categorical if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc", handleInvalid="keep") for c in text]
    inputs = [c for c in numeric if c in df.columns] + [f"{c}__idx" if c in text else c for c in categorical if c in df.columns]
    return stages, inputs


class BoostedModel:
    """A boosted model and the encoding of its inputs."""

    def __init__(self, encode, booster: boosting.Booster):
        self.encode, self.booster = encode, booster

    def transform(self, df: DataFrame) -> DataFrame:
        added = [c for c in self.booster.inputs if c not in df.columns]
        return self.booster.score(self.encode(df)).drop(*added)


def _fit_forest(train_df: DataFrame, numeric, categorical):
    stages, inputs = _indexers(train_df, numeric, categorical)
    # a node of fewer than 5 rows isn't split in the reference; Spark bounds the children, and 2 rows a child come closest
    forest = RandomForestClassifier(labelCol=TARGET, featuresCol="features", weightCol="class_weight", numTrees=200, maxDepth=10,
                                    minInstancesPerNode=2, seed=42, maxMemoryInMB=2048,  # more nodes per pass over the data
                                    # rows keep their node of each tree, in memory or on disk, and don't walk down all trees again at every level;
                                    # ten levels are a short lineage, so no level is written to the checkpoint folder
                                    cacheNodeIds=True, checkpointInterval=-1)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*stages, assembler, forest]).fit(train_df), inputs


def _fit_boosting(train_df: DataFrame, numeric, categorical):
    """Categories by number, the best split of each node; positives weigh negatives / positives."""
    stages, inputs = _indexers(train_df, numeric, categorical)
    encoder = Pipeline(stages=stages).fit(train_df)
    booster = boosting.fit(encoder.transform(train_df), inputs, TARGET, "positive_weight", rounds=200, depth=6, rate=0.1)
    return BoostedModel(encoder.transform, booster), inputs


def _fit_boosting_categorical(train_df: DataFrame, numeric, categorical):
    """Categories by ordered target means, one split a level; balanced class weights."""
    text = [c for c in categorical if c in train_df.columns and isinstance(train_df.schema[c].dataType, T.StringType)]
    targets = boosting.OrderedTargets(text, TARGET, ["device_id", "date"])
    inputs = [c for c in numeric if c in train_df.columns] + [targets.name(c) if c in text else c for c in categorical if c in train_df.columns]
    rows = sized(targets.fit(train_df), counted=train_df).select(*inputs, TARGET, "class_weight").persist()  # read for the edges, then for the blocks
    booster = boosting.fit(rows, inputs, TARGET, "class_weight", rounds=200, depth=6, rate=0.1, l2=3.0, symmetric=True)
    rows.unpersist()
    return BoostedModel(targets.transform, booster), inputs


MODELS = {"random_forest": _fit_forest, "gradient_boosting": _fit_boosting, "boosting_categorical": _fit_boosting_categorical}


def prepare(gold: DataFrame) -> DataFrame:
    cols = ["device_id", "date"] + [c for c in NUMERIC_FEATURES + CATEGORICAL_FEATURES if c in gold.columns] + [TARGET]
    num = [c for c in NUMERIC_FEATURES if c in gold.columns]
    return gold.select(*cols).fillna(0, subset=num)


def sized(df: DataFrame, rows_per_partition: int = 2_000_000, least_rows: int = 8_000, counted: DataFrame | None = None,
          others: int = 0) -> DataFrame:
    """As many partitions as there are cores, if each gets ``least_rows``, and more only beyond ``rows_per_partition`` rows each.
    Every tree level is a job over all partitions, and each partition hands on sums of its own for every node, feature
    and bin: many partitions cost more than the rows in them.  ``counted``: as many rows, counted for less.  ``others``: long
    tasks that run beside; with a partition for each core that they leave, no job waits for a second turn."""
    n = (counted or df).count()
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism - others)
    return df.repartition(max(1, -(-n // rows_per_partition), min(cores, -(-n // least_rows))))


def train(train_df: DataFrame, name: str, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES):
    """(model, names of its inputs) of one of ``MODELS``; ``train_df`` has the columns of ``class_weights``."""
    return MODELS[name](train_df, numeric, categorical)


def predict(model, df: DataFrame) -> DataFrame:
    """``df`` plus score, the probability of failure."""
    if isinstance(model, BoostedModel):
        return model.transform(df)
    p = model.transform(df)
    return p.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability")


# ---------------------------------------------------------------- M5 / M6 / W16
def _by_score(pred: DataFrame, label: str, score: str) -> DataFrame:
    return pred.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def classification_metrics(pred: DataFrame, label: str = TARGET, score: str = "score",
                           threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, F1 (0 on zero division), ROC AUC (ties 1/2), average precision."""
    pred = materialize(pred.select(F.col(label), F.col(score)), "scored")  # read several times: rows are scored once
    y = F.col(label) == 1
    p = F.col(score) >= threshold
    basic = pred.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    g = _by_score(pred, label, score)
    # AUC: each positive beats the negatives with a lower score, ties count 1/2
    asc = bucketed_prefix_sums(g, [], "s", ["neg"], inclusive=False)
    auc_num = asc.agg(F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("auc_num"))
    # AP: sum over descending distinct scores of (pos_k / P) * precision at k
    desc = bucketed_prefix_sums(g, [], "s", ["pos", "neg"], descending=True, inclusive=True)
    ap_num = desc.agg(F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("ap_num"))
    # three one-row aggregates -> scalars
    b = basic.first()
    a = auc_num.first()["auc_num"] or 0.0
    ap = ap_num.first()["ap_num"] or 0.0
    tp, fp, fn, tn = b["tp"], b["fp"], b["fn"], b["tn"]
    npos, nneg = tp + fn, fp + tn
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    row = ((tp + tn) / max(npos + nneg, 1), prec, rec, f1,
           a / (npos * nneg) if npos and nneg else None, ap / npos if npos else None, int(tp), int(fp), int(fn), int(tn))
    return pred.sparkSession.createDataFrame(
        [row], "accuracy double, precision double, recall double, f1 double, roc_auc double, "
               "average_precision double, tp bigint, fp bigint, fn bigint, tn bigint")


def confusion_matrix(pred: DataFrame, label: str = TARGET, score: str = "score", threshold: float = 0.5) -> DataFrame:
    return pred.groupBy(F.col(label).alias("actual"), (F.col(score) >= threshold).cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def roc_points(pred: DataFrame, label: str = TARGET, score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from the highest score down."""
    g = _by_score(pred, label, score)
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()  # two scalars
    d = bucketed_prefix_sums(g, [], "s", ["pos", "neg"], descending=True, inclusive=True)
    return d.select(F.col("s").alias("threshold"),
                    (F.col("cum_neg") / F.lit(max(tot["N"] or 0, 1))).alias("fpr"),
                    (F.col("cum_pos") / F.lit(max(tot["P"] or 0, 1))).alias("tpr"))


# ---------------------------------------------------------------- M7 / M8
def select_champion(metrics: DataFrame) -> DataFrame:
    """metrics: model, roc_auc, ... -> the max-AUC model (ties by name)."""
    return metrics.agg(F.max_by(F.struct("model", "roc_auc"), F.struct(F.col("roc_auc"), F.col("model"))).alias("c")) \
        .select(F.col("c.model").alias("champion"), F.col("c.roc_auc").alias("roc_auc"))


def feature_importance(model, inputs: list[str], top: int = 15) -> list[tuple[str, float]]:
    """The inputs with the largest shares of the impurity (forest) or loss (boosting) that splits took away."""
    if isinstance(model, BoostedModel):
        imp = model.booster.gains / max(model.booster.gains.sum(), 1e-300)
    else:
        imp = model.stages[-1].featureImportances.toArray()  # one value per input column
    pairs = sorted(zip(inputs, imp.tolist()), key=lambda x: (-x[1], x[0]))
    return pairs[:top]


# ---------------------------------------------------------------- M9
def batch_scores(pred: DataFrame, high_risk: float = 0.4) -> DataFrame:
    return pred.select("*", failure_tier_batch("score").alias("risk_tier"),
                       (F.col("score") >= high_risk).alias("high_risk"))


def score_summary(scored: DataFrame) -> DataFrame:
    """Devices, high-risk devices and devices per failure tier, one row."""
    return scored.agg(F.count(F.lit(1)).alias("devices"), F.count_if("high_risk").alias("high_risk_devices"),
                      *[F.count_if(F.col("risk_tier") == t).alias(f"tier_{t.lower()}") for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")])
