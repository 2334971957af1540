"""Root-cause analysis (A16/M21, M20): high-vs-low outcome rates and
propensity-score matching, both as distributed jobs.

Matching is 1-nearest-neighbour on a one-dimensional score: units are cut into
score buckets (bounded cut-point list); inside a bucket a window finds the
nearest opposite-arm unit below and above, and the per-bucket extremes (a
table with one row per bucket) carry the neighbour across bucket edges.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.exprs import np_round
from turnstile.functions.stats import exact_median
from turnstile.session import materialize

# Features screened by the simplified causal analysis, and the
# (treatment, hypothesis) pairs of the matching analysis.
SIMPLE_CAUSAL_FEATURES = ["error_count", "temperature_c", "signal_strength_dbm", "memory_usage_pct",
                          "age_days", "response_time_ms"]
HYPOTHESES = [
    ("error_count", "High error count causes failures"),
    ("temperature_c", "High temperature causes failures"),
    ("signal_strength_dbm", "Low signal strength causes failures"),
    ("memory_usage_pct", "High memory usage causes failures"),
    ("age_days", "Device age causes failures"),
]


# ---------------------------------------------------------------- P16 / A16
def high_low_rates(df: DataFrame, outcome: str, features=SIMPLE_CAUSAL_FEATURES) -> DataFrame:
    """Per feature: outcome rate above vs at-or-below the (exact) median, difference, risk ratio."""
    feats = [c for c in features if c in df.columns]
    med = exact_median(df, feats)
    y = F.col(outcome).cast("double")
    aggs = []
    for c in feats:
        hi = F.col(c) > F.lit(med[c])
        aggs += [F.avg(F.when(hi, y)).alias(f"{c}__h"), F.avg(F.when(~hi, y)).alias(f"{c}__l")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("treatment"), F.col(f"{c}__h").alias("h"), F.col(f"{c}__l").alias("l"))
            for c in feats]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.select(
        "treatment",
        np_round(F.col("h"), 4).alias("failure_rate_high"),
        np_round(F.col("l"), 4).alias("failure_rate_low"),
        np_round(F.col("h") - F.col("l"), 4).alias("difference"),
        np_round(F.col("h") / F.greatest(F.col("l"), F.lit(0.001)), 2).alias("risk_ratio"),
    ).orderBy(F.abs("difference").desc(), "treatment")


# ---------------------------------------------------------------- M20
def propensity(df: DataFrame, treat: str, confounders: list[str]) -> DataFrame:
    va = VectorAssembler(inputCols=confounders, outputCol="_x", handleInvalid="keep")
    x = va.transform(df)
    lr = LogisticRegression(featuresCol="_x", labelCol=treat, maxIter=100)
    m = lr.fit(x)
    return m.transform(x).withColumn("ps", vector_to_array("probability")[1]).drop(
        "_x", "rawPrediction", "probability", "prediction")


def nearest_opposite(df: DataFrame, treat: str, score: str, value: str, key: str = "_key",
                     bucket_rows: int = 200_000) -> DataFrame:
    """For every unit, the outcome of the nearest unit of the other arm by ``score``.

    Units of equal score are ordered by ``key``, a hash that knows nothing of the outcome.  Range
    partitions of (score, key) are the buckets, as many as the row count asks for; a frequent score is
    split among them by its keys.
    """
    n_buckets = max(16, -(-df.count() // bucket_rows))
    b = materialize(df.repartitionByRange(n_buckets, score, key).withColumn("_b", F.spark_partition_id()), "matching-buckets")
    arm = F.col(treat) == 1
    sv = F.struct(F.col(score).alias("s"), F.col(value).alias("v"))
    # growing frames only (unbounded preceding .. -1), in both directions: O(n) per bucket;
    # a frame running to unbounded following would be re-aggregated for every row
    w_up = Window.partitionBy("_b").orderBy(F.col(score).asc(), F.col(key).asc())
    w_dn = Window.partitionBy("_b").orderBy(F.col(score).desc(), F.col(key).desc())
    grow_up = w_up.rowsBetween(Window.unboundedPreceding, -1)
    grow_dn = w_dn.rowsBetween(Window.unboundedPreceding, -1)
    prev_t = F.last(F.when(arm, sv), ignorenulls=True).over(grow_up)
    prev_c = F.last(F.when(~arm, sv), ignorenulls=True).over(grow_up)
    next_t = F.last(F.when(arm, sv), ignorenulls=True).over(grow_dn)
    next_c = F.last(F.when(~arm, sv), ignorenulls=True).over(grow_dn)
    inb = b.select("*", prev_t.alias("pt"), prev_c.alias("pc"), next_t.alias("nt"), next_c.alias("nc"))
    # per-bucket extremes of each arm (one row per bucket) carried across bucket edges
    at = F.struct(F.col(score), F.col(key))
    ext = b.groupBy("_b").agg(
        F.max_by(F.when(arm, sv), F.when(arm, at)).alias("max_t"),
        F.max_by(F.when(~arm, sv), F.when(~arm, at)).alias("max_c"),
        F.min_by(F.when(arm, sv), F.when(arm, at)).alias("min_t"),
        F.min_by(F.when(~arm, sv), F.when(~arm, at)).alias("min_c"))
    wb_up = Window.orderBy(F.col("_b").asc()).rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    wb_dn = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = ext.select(
        "_b",
        F.last("max_t", ignorenulls=True).over(wb_up).alias("cpt"),
        F.last("max_c", ignorenulls=True).over(wb_up).alias("cpc"),
        F.last("min_t", ignorenulls=True).over(wb_dn).alias("cnt"),
        F.last("min_c", ignorenulls=True).over(wb_dn).alias("cnc"))
    j = inb.join(carry, "_b", "left")
    below = F.when(arm, F.coalesce("pc", "cpc")).otherwise(F.coalesce("pt", "cpt"))
    above = F.when(arm, F.coalesce("nc", "cnc")).otherwise(F.coalesce("nt", "cnt"))
    d_below = F.col(score) - below["s"]
    d_above = above["s"] - F.col(score)
    pick = (F.when(below.isNull(), above).when(above.isNull(), below)
            .when(d_below <= d_above, below).otherwise(above))
    return j.select(*df.columns, pick["v"].alias("matched_outcome"))


def matching_ate(df: DataFrame, treat: str, outcome: str, confounders: list[str]) -> float | None:
    """ATE = mean over all units of (treated outcome - control outcome) with the missing
    potential outcome taken from the nearest opposite-arm unit by propensity."""
    # the key breaks ties of the score: a hash of the unit, without its outcome or arm
    unit = [c for c in ("device_id", "date") if c in df.columns] or confounders
    x = df.select(treat, outcome, *confounders, F.xxhash64(*unit).alias("_key")).fillna(0).persist()  # read by every optimiser step
    p = propensity(x, treat, confounders).select(treat, outcome, "_key", "ps").persist()  # read by the matching passes, without the confounders
    m = nearest_opposite(p, treat, "ps", outcome)
    eff = F.when(F.col(treat) == 1, F.col(outcome) - F.col("matched_outcome")).otherwise(
        F.col("matched_outcome") - F.col(outcome))
    ate = m.agg(F.avg(eff.cast("double"))).first()[0]
    p.unpersist()
    x.unpersist()
    return ate


def causal_effects(df: DataFrame, outcome: str, feature_names: list[str], hypotheses=HYPOTHESES) -> DataFrame:
    """ATE per hypothesis: treatment = feature above its median; confounders = the
    first five other features in ``feature_names`` order."""
    found = [(t, desc) for t, desc in hypotheses if t in df.columns]
    med = exact_median(df, [t for t, _ in found])

    def effect(pair):
        t, desc = pair
        conf = [c for c in feature_names if c != t and c in df.columns][:5]
        x = df.withColumn("_treat", (F.col(t) > F.lit(med[t])).cast("int"))
        ate = matching_ate(x, "_treat", outcome, conf)
        return t, desc, None if ate is None else round(float(ate), 4), None if ate is None else abs(ate) > 0.01

    # an optimiser's steps are many small jobs, which leave cores to the other hypotheses
    with ThreadPoolExecutor(max(len(found), 1)) as pool:
        rows = [r.result() for r in [pool.submit(inheritable_thread_target(df.sparkSession)(effect), pair) for pair in found]]
    return df.sparkSession.createDataFrame(rows, "treatment string, hypothesis string, ate double, significant boolean")
