"""Error patterns: baskets, co-occurrence itemsets and rules, Markov transitions,
stationary distribution and severity escalations (A6, A7, A14, A15, M11-M16, W9, W10).

A basket is the sorted list of a device-day's distinct codes.  Itemsets are counted level by
level up to the wanted size, so work is bounded by that size, not by the largest basket.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions.exprs import severity_rank
from turnstile.session import drop_path, materialize, scratch_path


def code_vocabulary(errors: DataFrame, col: str = "error_code") -> list[str]:
    """The distinct codes: the error catalogue of a device type, for columns and states."""
    return sorted(r[0] for r in errors.select(col).where(F.col(col).isNotNull()).distinct().collect())


# ---------------------------------------------------------------- A6
def baskets(errors: DataFrame, min_raw: int = 2) -> DataFrame:
    """One row per device-day with >= ``min_raw`` raw errors (before dedup, as executed):
    n_raw and items, the sorted distinct codes.  Codes are counted first (map-side combined), so a busy
    device-day reaches the second aggregate as one row a code."""
    codes = errors.groupBy("device_id", F.to_date("timestamp").alias("date"), "error_code").agg(F.count(F.lit(1)).alias("n"))
    g = codes.groupBy("device_id", "date").agg(F.sum("n").alias("n_raw"), F.sort_array(F.collect_list("error_code")).alias("items"))
    return g.where(F.col("n_raw") >= min_raw)


# ---------------------------------------------------------------- M11
def frequent_itemsets(errors: DataFrame, min_support: float = 0.05, max_len: int = 3,
                      min_transactions: int = 10) -> DataFrame:
    """(items array<string> sorted, size, count, support) for support >= min_support."""
    t = baskets(errors).groupBy("items").agg(F.count(F.lit(1)).alias("n"))  # equal baskets are counted once
    t = materialize(t.withColumn("basket", F.monotonically_increasing_id()), "baskets")
    return itemsets(t, min_support, max_len, min_transactions)


def itemsets(t: DataFrame, min_support: float, max_len: int, min_transactions: int = 1) -> DataFrame:
    """Frequent sets of up to ``max_len`` items of weighted baskets (basket, items sorted and distinct, n).

    A set of k + 1 items is counted in the baskets where two frequent sets of k items share all but their last
    item.  Sets are counted per task first, then over all; a basket is spread over its sets, no task holds more of it
    than the last items that follow one set."""
    total = t.agg(F.sum("n")).first()[0] or 0
    schema = "items array<string>, size int, count bigint, support double"
    if total < min_transactions or max_len < 1:
        return t.sparkSession.createDataFrame([], schema)
    support = F.col("count") / F.lit(total)
    rows = t.select("basket", "n", F.array().cast("array<string>").alias("prefix"), F.explode("items").alias("last"))
    out = None
    for size in range(1, max_len + 1):
        counted = rows.groupBy("prefix", "last").agg(F.sum("n").alias("count")).where(support >= min_support)
        frequent = materialize(counted, "itemsets")
        found = frequent.select(F.concat("prefix", F.array("last")).alias("items"), F.lit(size).alias("size"), "count", support.alias("support"))
        out = found if out is None else out.unionByName(found)
        if size < max_len:
            tails = (rows.join(frequent, ["prefix", "last"], "left_semi").groupBy("basket", "prefix")
                         .agg(F.array_sort(F.collect_list("last")).alias("tails"), F.first("n").alias("n")).where(F.size("tails") > 1))
            each = tails.select("basket", "n", "prefix", "tails", F.explode(F.sequence(F.lit(1), F.size("tails") - 1)).alias("i"))
            rows = each.select("basket", "n", F.concat("prefix", F.array(F.expr("tails[i - 1]"))).alias("prefix"),
                               F.explode(F.expr("slice(tails, i + 1, size(tails))")).alias("last"))
    return out


# ---------------------------------------------------------------- M12
def association_rules(itemsets: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """All antecedent => consequent splits of frequent itemsets (any consequent size)."""
    sup = itemsets.select(F.col("items").alias("_i"), F.col("support").alias("_s"))
    multi = itemsets.where(F.col("size") >= 2)
    # proper non-empty subsets via bit masks over the (<= max_len) items
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("size")).cast("int") - 2)
    splits = multi.select("items", "support", F.explode(masks).alias("mask")).select(
        "items", "support",
        F.filter("items", lambda x, i: F.pmod(F.floor(F.col("mask") / F.pow(F.lit(2), i)), F.lit(2)) == 1).alias("antecedent"),
        F.filter("items", lambda x, i: F.pmod(F.floor(F.col("mask") / F.pow(F.lit(2), i)), F.lit(2)) == 0).alias("consequent"))
    a = splits.join(sup.withColumnRenamed("_s", "antecedent_support"), F.col("antecedent") == F.col("_i")).drop("_i")
    c = a.join(sup.withColumnRenamed("_s", "consequent_support"), F.col("consequent") == F.col("_i")).drop("_i")
    conf = F.col("support") / F.col("antecedent_support")
    r = c.select(
        F.array_join("antecedent", ", ").alias("antecedents"),
        F.array_join("consequent", ", ").alias("consequents"),
        "antecedent_support", "consequent_support", "support",
        conf.alias("confidence"),
        (conf / F.col("consequent_support")).alias("lift"),
        (F.col("support") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
        F.when(conf >= 1, F.lit(None).cast("double"))
        .otherwise((F.lit(1.0) - F.col("consequent_support")) / (F.lit(1.0) - conf)).alias("conviction"),
    )
    return r.where(F.col("confidence") >= min_confidence)


def rule_metrics(rules: DataFrame) -> DataFrame:
    """Rule count, max lift, mean confidence."""
    return rules.agg(F.count(F.lit(1)).alias("rule_count"), F.max("lift").alias("max_lift"),
                     F.avg("confidence").alias("mean_confidence"))


# ---------------------------------------------------------------- W9 / M13 / M14
def consecutive_pairs(errors: DataFrame, cols: list[str], order=("timestamp", "event_id")) -> DataFrame:
    """Each event of a device with the device's next event (``next_<col>``), in time order.

    A per-device window would put a device that sends a third of all events in
    one task.  Instead the window runs per device and hour, and the pairs that cross
    an hour's end (its last event -> first event of the device's next active
    hour) come from a table with one row per active hour, whose window
    is bounded by the calendar."""
    hour = F.date_trunc("hour", "timestamp").alias("_hour")
    e = errors.select("device_id", hour, *[F.col(c) for c in set(cols) | set(order)])
    w = Window.partitionBy("device_id", "_hour").orderBy(*order)
    inner = e.select("device_id", *cols, *[F.lead(c).over(w).alias(f"next_{c}") for c in cols],
                     F.lead(order[-1]).over(w).isNotNull().alias("_has_next")).where("_has_next").drop("_has_next")
    key = F.struct(*[F.col(c) for c in order])
    ends = e.groupBy("device_id", "_hour").agg(F.min_by(F.struct(*cols), key).alias("first"),
                                             F.max_by(F.struct(*cols), key).alias("last"))
    wd = Window.partitionBy("device_id").orderBy("_hour")
    edge = ends.select("device_id", "last", F.lead("first").over(wd).alias("nxt")).where(F.col("nxt").isNotNull())
    edge = edge.select("device_id", *[F.col(f"last.{c}").alias(c) for c in cols],
                       *[F.col(f"nxt.{c}").alias(f"next_{c}") for c in cols])
    return inner.unionByName(edge)


def transitions(errors: DataFrame, order=("timestamp", "event_id")) -> DataFrame:
    """(device_id, from_error, to_error) for consecutive errors of a device."""
    p = consecutive_pairs(errors, ["error_code"], order)
    return p.select("device_id", F.col("error_code").alias("from_error"), F.col("next_error_code").alias("to_error"))


def transition_counts(errors: DataFrame) -> DataFrame:
    return transitions(errors).groupBy("from_error", "to_error").agg(F.count(F.lit(1)).alias("count"))


def transition_matrix(errors: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Wide K x K matrix: one row per from-state, one probability column per to-state,
    zero-filled (explicit pivot values, no Cartesian product); empty rows divide by 1."""
    codes = codes or code_vocabulary(errors)
    tc = transition_counts(errors)
    wide = tc.groupBy("from_error").pivot("to_error", codes).agg(F.sum("count")).fillna(0)
    states = errors.select(F.col("error_code").alias("from_error")).distinct()
    wide = states.join(wide, "from_error", "left").fillna(0)
    total = sum((F.col(c) for c in codes), F.lit(0))
    denom = F.when(total == 0, F.lit(1)).otherwise(total)
    return wide.select("from_error", *[(F.col(c) / denom).alias(c) for c in codes])


def transition_probabilities(errors: DataFrame) -> DataFrame:
    """Long form (from, to, count, probability) for observed transitions."""
    tc = transition_counts(errors)
    w = Window.partitionBy("from_error")
    return tc.select("from_error", "to_error", "count",
                     (F.col("count") / F.sum("count").over(w)).alias("probability"))


def significant_transitions(errors: DataFrame, threshold: float = 0.1) -> DataFrame:
    tp = transition_probabilities(errors)
    return tp.where(F.col("probability") > threshold).select(
        "from_error", "to_error", F.round("probability", 4).alias("probability"), "count")


# ---------------------------------------------------------------- M15
#: Up to so many codes the chain is solved as a dense matrix (2 MB); beyond it by joins.
DENSE_CODES = 512


def stationary_distribution(errors: DataFrame, dense_codes: int = DENSE_CODES) -> DataFrame:
    """Left eigenvector of the transition matrix for the eigenvalue nearest 1, of sum 1, absolute values."""
    if errors.select("error_code").where(F.col("error_code").isNotNull()).distinct().count() > dense_codes:
        return stationary_by_joins(transition_counts(errors), errors.select(F.col("error_code").alias("code")).where("code is not null").distinct())
    codes = code_vocabulary(errors)
    tc = transition_counts(errors).collect()
    idx = {c: i for i, c in enumerate(codes)}
    m = np.zeros((len(codes), len(codes)))
    for r in tc:
        m[idx[r["from_error"]], idx[r["to_error"]]] += r["count"]
    rs = m.sum(axis=1, keepdims=True)
    rs[rs == 0] = 1
    p = m / rs
    vals, vecs = np.linalg.eig(p.T)
    k = int(np.argmin(np.abs(vals - 1)))
    v = np.real(vecs[:, k])
    v = v / v.sum()
    rows = [(c, float(abs(v[i]))) for i, c in enumerate(codes)]
    return errors.sparkSession.createDataFrame(rows, "error_code string, stationary_probability double")


def stationary_by_joins(counts: DataFrame, codes: DataFrame, tol: float = 1e-9, max_steps: int = 1000) -> DataFrame:
    """The same by power iteration over the transitions that occur: (from_error, to_error, count), codes (code).

    A step is a join of the present shares with the transitions and a sum by code; half the shares stay, so a chain that
    alternates settles too.  It ends when the shares move by less than ``tol`` in all, or after ``max_steps``.  Each step's shares are
    written and the ones before removed, so the lineage stays short and the folder small."""
    spark = counts.sparkSession
    whole = counts.groupBy("from_error").agg(F.sum("count").alias("whole"))  # no window: a busy code's row sum is pre-aggregated
    moves = materialize(counts.join(whole, "from_error").select(F.col("from_error").alias("code"), "to_error", (F.col("count") / F.col("whole")).alias("p")), "transitions")
    n = codes.count()
    base = scratch_path(spark, f"stationary/{uuid.uuid4().hex}")
    shares = codes.select("code", F.lit(1.0 / max(n, 1)).alias("x"))
    for step in range(max_steps):
        arrived = moves.join(shares, "code").groupBy(F.col("to_error").alias("code")).agg(F.sum(F.col("p") * F.col("x")).alias("y"))
        after = shares.join(arrived, "code", "left").select("code", "x", (0.5 * F.col("x") + 0.5 * F.coalesce("y", F.lit(0.0))).alias("next"))
        after.write.parquet(f"{base}/{step}")
        after = spark.read.parquet(f"{base}/{step}")
        total = after.agg(F.sum("next")).first()[0] or 0.0  # codes that nothing follows lose their share
        if not total:
            break
        moved = after.agg(F.sum(F.abs(F.col("next") / total - F.col("x")))).first()[0]
        shares = after.select("code", (F.col("next") / total).alias("x"))
        drop_path(spark, f"{base}/{step - 1}")
        if moved < tol:
            break
    return shares.select(F.col("code").alias("error_code"), F.col("x").alias("stationary_probability"))


# ---------------------------------------------------------------- W10 / A7 / A15
def escalations(errors: DataFrame, order=("timestamp", "event_id")) -> DataFrame:
    """Consecutive pairs (per device, time order) whose severity rank increases."""
    p = consecutive_pairs(errors, ["timestamp", "severity", "error_code"], order)
    return p.where(severity_rank("next_severity") > severity_rank("severity")).select(
        "device_id", "timestamp", F.col("severity").alias("from_severity"), F.col("next_severity").alias("to_severity"),
        F.col("error_code").alias("from_error"), F.col("next_error_code").alias("to_error"))


def escalation_paths(errors: DataFrame) -> DataFrame:
    return escalations(errors).groupBy("from_severity", "to_severity").agg(F.count(F.lit(1)).alias("count"))


def daily_escalation_count(errors: DataFrame, day) -> DataFrame:
    """Escalations among one day's errors (time order; unknown severity ranks 0)."""
    d = errors.where(F.to_date("timestamp") == F.lit(day).cast("date"))
    r = F.coalesce(severity_rank("severity"), F.lit(0))
    x = consecutive_pairs(d.select("device_id", "timestamp", "event_id", r.alias("rank")), ["rank"])
    return x.agg(F.count_if(F.col("next_rank") > F.col("rank")).alias("escalations"))


def daily_code_pairs(errors: DataFrame, day, top: int = 5) -> DataFrame:
    """Devices per unordered pair of distinct codes on one day; top ``top`` by count, ties by pair.

    A device's pairs come from its distinct codes of the day, a part of the error catalogue, whatever its
    number of events; they are combined map-side."""
    d = errors.where(F.to_date("timestamp") == F.lit(day).cast("date"))
    codes = (d.groupBy("device_id", "error_code").agg(F.lit(1)).groupBy("device_id")
              .agg(F.sort_array(F.collect_list("error_code")).alias("codes")))
    after = lambda a, i: F.transform(
        F.slice("codes", i + 2, F.greatest(F.size("codes") - i - 1, F.lit(0))), lambda b: F.struct(a.alias("code_a"), b.alias("code_b")))
    pairs = codes.select(F.explode(F.flatten(F.transform("codes", after))).alias("p"))
    return (pairs.groupBy("p.code_a", "p.code_b").agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(F.col("count").desc(), "code_a", "code_b").limit(top))
