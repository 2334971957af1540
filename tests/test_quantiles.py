"""Exact quantiles: missing values, infinities, ranges at the limits of doubles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.functions.stats import exact_quantiles, value_at_rank

NAN, INF = float("nan"), float("inf")


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def plain(values, q):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    pos = q * (len(v) - 1)
    a, b, part = v[math.floor(pos)], v[math.ceil(pos)], pos - math.floor(pos)
    if not part or a == b:
        return a
    return a + b if math.isinf(a) or math.isinf(b) else a * (1 - part) + b * part


rng = np.random.default_rng(8)
CASES = {
    "nan": [*rng.normal(size=3000), NAN, NAN, None],
    "infinite": [*rng.normal(size=3000), INF, -INF, -INF, None],
    "mostly_infinite": [1.0, 2.0, INF, INF, INF],
    "both": [-INF, INF],
    "missing": [NAN, None],
    "huge": [*(rng.uniform(-1, 1, 3000) * 1.7e308), 1.7e308, -1.7e308],
    "neighbours": [1.0, math.nextafter(1.0, 2), *[math.nextafter(math.nextafter(1.0, 2), 2)] * 3000],
    "denormal": [0.0, 5e-324, 1e-323, *[1.5e-323] * 3000],
    "spread": [1e-300, *[2e-300] * 1500, *rng.uniform(0, 1, 1500), 1e300],
    "same": [3.0] * 2500,
}


@pytest.mark.parametrize("name", list(CASES))
def test_quantiles(spark, name):
    df = frame(spark, CASES[name])
    for q in (0.0, 0.3, 0.5, 1.0):
        got, want = exact_quantiles(df, ["x"], q, max_fetch=200)["x"], plain(CASES[name], q)
        assert got == want or (got is not None and want is not None and (math.isnan(got) and math.isnan(want) or math.isclose(got, want, rel_tol=1e-12)))


def test_rank_and_several_columns(spark):
    df = frame(spark, CASES["infinite"]).withColumn("y", F.when(F.col("x") > 0, F.lit(NAN)).otherwise(F.col("x"))).withColumn("z", F.lit(None).cast("double"))
    assert value_at_rank(df, "x", 0, 3003) == -INF and value_at_rank(df, "x", 3002, 3003) == INF
    got = exact_quantiles(df, ["x", "y", "z"])
    values = [v for v in CASES["infinite"] if v is not None]
    assert got["z"] is None and math.isclose(got["x"], plain(values, 0.5)) and math.isclose(got["y"], plain([v for v in values if v <= 0], 0.5))
