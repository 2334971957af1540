"""Profiles merged from stored states against one pass over the rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.operators import features, profiles, quality

SCHEMA = "day date, x double, n int, s string"


def table(spark, seed=3, days=5, rows=400):
    import datetime

    rng = np.random.default_rng(seed)
    out = []
    for i in range(days * rows):
        # a third of all rows on the first day; large offsets, so that sums of squares would cancel
        day = datetime.date(2024, 1, 1 + (0 if i % 3 == 0 else i % days))
        x = 1e8 + float(rng.normal())
        out.append((day, None if i % 17 == 0 else x, int(rng.integers(0, 50)), f"v{rng.integers(0, 300)}"))
    return spark.createDataFrame(out, SCHEMA), out


def row(states, column):
    return profiles.profile_of(states).where(F.col("column") == column).first()


def check(p, values, n_rows):
    real = np.array([v for v in values if v is not None])
    assert (p.rows, p.nulls, p.finite) == (n_rows, n_rows - len(real), len(real))
    assert (p.low, p.high) == (real.min(), real.max())
    assert math.isclose(p["mean"], real.mean(), rel_tol=1e-12) and math.isclose(p["std"], real.std(ddof=1), rel_tol=1e-6)
    assert abs(p.distinct_estimate - len(set(values) - {None})) <= 0.05 * len(set(real)) + 1
    for q, at in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        below, upto = (real < p[q]).mean(), (real <= p[q]).mean()
        assert below - 0.0133 <= at <= upto + 0.0133


def test_days_in_parts_and_redelivered(spark, tmp_path):
    df, rows = table(spark)
    store = profiles.ProfileStore(spark, str(tmp_path / "states"))
    assert store.states() is None
    half = F.col("n") < 25
    store.add(df.where(half), "day", "a")
    store.add(df.where(~half), "day", "b")
    store.add(df.where(half), "day", "a")  # comes again: replaced
    states = store.states()
    for i, c in ((1, "x"), (2, "n")):
        check(row(states, c), [r[i] for r in rows], len(rows))
    assert abs(row(states, "s").distinct_estimate - 300) <= 15 and row(states, "s").low is None
    by_day = {r.day: r for r in profiles.profile_of(states, ["day"]).where(F.col("column") == "x").collect()}
    for day in {r[0] for r in rows}:
        mine = [r[1] for r in rows if r[0] == day]
        check(by_day[day], mine, len(mine))


def test_merging_is_associative(spark):
    df, rows = table(spark, seed=8)
    days = profiles.column_states(df, "day")
    twice = profiles.merge_states(profiles.merge_states(days, [F.dayofweek("day").alias("w")]).drop("w"))
    check(row(twice, "x"), [r[1] for r in rows], len(rows))


def test_nan_infinity_nulls_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(None, nan, 1, None), (None, inf, None, None), (None, 0.0, 2, None), (None, -0.0, 3, None), (None, -inf, 2, None)], SCHEMA)
    p = row(profiles.column_states(df, "day"), "x")
    assert (p.rows, p.nulls, p.nans, p.infinite, p.finite, p.low, p.high, p["mean"], p["std"]) == (5, 0, 1, 2, 2, -inf, inf, 0.0, 0.0)
    assert round(p.distinct_estimate) == 3
    p = row(profiles.column_states(df, "day"), "s")
    assert (p.nulls, p.low, p["mean"], p.p50, p.distinct_estimate) == (5, None, None, None, 0)
    only = spark.createDataFrame([(None, None, None, "a")], SCHEMA)
    p = row(profiles.column_states(only, "day"), "x")
    assert (p.finite, p["mean"], p["std"], p.p99) == (0, None, None, None)
    assert profiles.profile_of(profiles.column_states(df.limit(0), "day")).count() == 0


def test_checks_from_states(spark):
    df, _ = table(spark)
    df = df.withColumn("x", F.when(F.col("n") == 7, float("inf")).otherwise(F.col("x")))
    suite = [quality.column_exists("x"), quality.column_exists("y"), quality.not_null("x", 0.9), quality.not_null("x", 0.99), quality.not_null("y"),
             quality.between("n", 0, 49), quality.between("n", 1, 49), quality.between("y", 0, 1), quality.mean_between("n", 20, 30),
             quality.mean_between("n", 30, 40), quality.row_count_between(1, 10), quality.row_count_between(1, 10_000), quality.no_infinity()]
    whole = [tuple(r) for r in quality.validate(df.drop("day"), suite, "l", "t").collect()]
    merged = [tuple(r) for r in profiles.validate_states(profiles.column_states(df, "day"), suite, "l", "t").collect()]
    for a, b in zip(whole, merged, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == b[5] or math.isclose(a[5], b[5], rel_tol=1e-12) or (a[3].endswith("(y)") or "y" in a[3])
    with pytest.raises(ValueError):
        profiles.validate_states(profiles.column_states(df, "day"), [quality.unique("n")], "l", "t")


def test_maintenance_windows_of_a_busy_device(spark):
    import datetime

    rng = np.random.default_rng(1)
    start = datetime.date(2024, 1, 1)
    rows = [(i, 1 if i % 3 == 0 else int(rng.integers(2, 9)), start + datetime.timedelta(days=int(rng.integers(0, 90))),
             None if i % 11 == 0 else float(rng.integers(1, 500))) for i in range(600)]
    rows += [(700, 1, None, 5.0), (701, None, start, 6.0)]
    df = spark.createDataFrame(rows, "maintenance_id int, device_id int, date date, cost_gbp double")
    made = {r.maintenance_id: r for r in features.maintenance_window_features(df).collect()}
    assert len(made) == len(rows)
    for i, device, day, _ in rows[:600]:
        near = [c for _, d, t, c in rows if d == device and t is not None and 0 <= (day - t).days < 30 and c is not None]
        before = [k for k, d, t, _ in rows if d == device and (t is None or (t, k) <= (day, i))]
        assert made[i]["cost_30d"] == (sum(near) if near else None) and made[i].running_maintenance_count == len(before)
    assert (made[700].running_maintenance_count, made[700]["cost_30d"], made[701].running_maintenance_count) == (1, 5.0, 1)
