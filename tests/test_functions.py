"""Column expressions and distributed statistics helpers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.functions import exprs as X
from turnstile.functions.stats import bucketed_prefix_sums, exact_quantiles, ks_pvalue, value_at_rank


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (150.0,), (-3.0,), (42.0,)], "x double")
    got = [r[0] for r in df.select(X.clip_keep_null("x", 0, 100).alias("y")).collect()]
    assert got == [None, 100.0, 0.0, 42.0]


def test_title_case_matches_python(spark):
    vals = [" wide_entry ", "scheidt_bachmann", "KINGS CROSS", "firmware_update", "Entry"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(X.std_title("s")).collect()]
    assert got == [v.strip().title() for v in vals]


def test_np_round_is_half_even_on_binary_value(spark):
    df = spark.createDataFrame([(80.725,), (0.125,), (2.5,)], "x double")
    got = [r[0] for r in df.select(X.np_round("x", 2).alias("r")).collect()]
    assert got == [float(np.round(80.725, 2)), float(np.round(0.125, 2)), 2.5]


def test_tier_edges_differ_between_batch_and_serving(spark):
    df = spark.createDataFrame([(0.2,), (0.4,), (0.7,), (0.05,)], "p double")
    rows = df.select(X.failure_tier_batch("p").alias("b"), X.failure_tier_serving("p")["tier"].alias("s")).collect()
    assert [(r.b, r.s) for r in rows] == [("LOW", "MEDIUM"), ("MEDIUM", "HIGH"), ("HIGH", "CRITICAL"), ("LOW", "LOW")]


@pytest.mark.parametrize("q", [0.5, 0.08, 0.93, 0.0, 1.0])
def test_exact_quantiles_match_numpy_with_heavy_ties(spark, q):
    random.seed(7)
    vals = [random.random() * 100 for _ in range(3000)] + [5.0] * 1500 + [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], q, buckets=64, max_fetch=50)["x"]
    exp = float(np.percentile(np.array([v for v in vals if v is not None]), q * 100))
    assert math.isclose(got, exp, rel_tol=0, abs_tol=1e-12)


def test_value_at_rank(spark):
    df = spark.createDataFrame([(float(v),) for v in [9, 1, 5, 3, 7, 3]], "x double")
    assert [value_at_rank(df, "x", k, 6) for k in range(6)] == [1.0, 3.0, 3.0, 5.0, 7.0, 9.0]


def test_bucketed_prefix_sums_equal_plain_cumsum(spark):
    rows = [(g, float(v), 1) for g in ("a", "b") for v in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, c int")
    got = {(r.g, r.v): r.cum_c for r in bucketed_prefix_sums(df, ["g"], "v", ["c"], n_buckets=16).collect()}
    assert all(got[(g, float(v))] == v + 1 for g in ("a", "b") for v in range(500))
    desc = {r.v: r.cum_c for r in bucketed_prefix_sums(df.where("g = 'a'"), [], "v", ["c"], n_buckets=8,
                                                          descending=True, inclusive=False).collect()}
    assert all(desc[float(v)] == 499 - v for v in range(500))


def test_ks_pvalue_limits():
    assert ks_pvalue(0.0, 100, 100) == 1.0
    assert ks_pvalue(0.5, 1000, 1000) < 1e-6
