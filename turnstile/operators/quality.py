"""Data-quality expectations (Q1-Q11, Q13) evaluated as one aggregation per table.

An expectation contributes aggregate expressions to a single ``agg`` over the
table and a (success, observed) pair computed from that one-row result; the
report is a lazily built DataFrame (explode of an array of structs), so no
data row reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)


@dataclass
class Expectation:
    kind: str
    column: str | None = None
    args: tuple = field(default_factory=tuple)

    def describe(self) -> str:
        a = ", ".join(str(x) for x in self.args)
        return f"{self.kind}({self.column}{', ' if a and self.column else ''}{a})" if self.column else f"{self.kind}({a})"


def column_exists(c):
    return Expectation("column_exists", c)


def not_null(c, mostly=1.0):
    return Expectation("not_null", c, (mostly,))


def between(c, lo, hi):
    return Expectation("between", c, (lo, hi))


def in_set(c, values):
    return Expectation("in_set", c, (tuple(values),))


def unique(c):
    return Expectation("unique", c)


def row_count_between(lo, hi):
    return Expectation("row_count_between", None, (lo, hi))


def mean_between(c, lo, hi):
    return Expectation("mean_between", c, (lo, hi))


def no_infinity():
    return Expectation("no_infinity")


def _plan(df: DataFrame, exps: list[Expectation]):
    """-> (aggregate exprs, per-expectation (success, observed) builders)."""
    aggs: list[Column] = []
    outs = []
    cols = set(df.columns)
    for i, e in enumerate(exps):
        p = f"e{i}_"
        c = e.column
        if e.kind != "column_exists" and c is not None and c not in cols:
            outs.append((lambda: F.lit(False), lambda: F.lit(None).cast("double")))
            continue
        if e.kind == "column_exists":
            ok = c in cols
            outs.append((lambda ok=ok: F.lit(ok), lambda ok=ok: F.lit(1.0 if ok else 0.0)))
        elif e.kind == "not_null":
            aggs.append(F.avg(F.col(c).isNull().cast("double")).alias(p + "nr"))
            mostly = float(e.args[0])
            outs.append((lambda p=p, m=mostly: (F.lit(1.0) - F.col(p + "nr")) >= F.lit(m),
                         lambda p=p: F.col(p + "nr")))
        elif e.kind == "between":
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(p + "mn"), F.max(x).alias(p + "mx")]
            lo, hi = e.args
            outs.append((lambda p=p, lo=lo, hi=hi: F.coalesce((F.col(p + "mn") >= F.lit(float(lo))) &
                                                               (F.col(p + "mx") <= F.lit(float(hi))), F.lit(False)),
                         lambda p=p: F.col(p + "mx")))
        elif e.kind == "in_set":
            allowed = list(e.args[0])
            aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(allowed)).alias(p + "bad"))
            outs.append((lambda p=p: F.col(p + "bad") == 0, lambda p=p: F.col(p + "bad").cast("double")))
        elif e.kind == "unique":
            aggs += [F.count_distinct(F.col(c)).alias(p + "nd"), F.count(F.col(c)).alias(p + "n")]
            outs.append((lambda p=p: F.col(p + "nd") == F.col(p + "n"), lambda p=p: F.col(p + "nd").cast("double")))
        elif e.kind == "row_count_between":
            aggs.append(F.count(F.lit(1)).alias(p + "n"))
            lo, hi = e.args
            outs.append((lambda p=p, lo=lo, hi=hi: F.col(p + "n").between(lo, hi), lambda p=p: F.col(p + "n").cast("double")))
        elif e.kind == "mean_between":
            aggs.append(F.avg(F.col(c).cast("double")).alias(p + "m"))
            lo, hi = e.args
            outs.append((lambda p=p, lo=lo, hi=hi: F.coalesce(F.col(p + "m").between(float(lo), float(hi)), F.lit(False)),
                         lambda p=p: F.col(p + "m")))
        elif e.kind == "no_infinity":
            num = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
            cond = None
            for n in num:
                ci = F.abs(F.col(n)) == F.lit(float("inf"))
                cond = ci if cond is None else (cond | ci)
            aggs.append((F.count_if(cond) if cond is not None else F.lit(0)).alias(p + "inf"))
            outs.append((lambda p=p: F.col(p + "inf") == 0, lambda p=p: F.col(p + "inf").cast("double")))
        else:
            raise ValueError(e.kind)
    return aggs, outs


def validate(df: DataFrame, exps: list[Expectation], layer: str, table: str) -> DataFrame:
    """Result rows: layer, table, check_id, expectation, success, observed."""
    aggs, outs = _plan(df, exps)
    one = df.agg(*aggs) if aggs else df.sparkSession.range(1).select(F.lit(1).alias("_one"))
    rows = [F.struct(F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit(i).alias("check_id"),
                     F.lit(e.describe()).alias("expectation"), ok().alias("success"),
                     obs().cast("double").alias("observed"))
            for i, (e, (ok, obs)) in enumerate(zip(exps, outs))]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def summarize(results: DataFrame) -> DataFrame:
    """Q10: passed / failed / pass rate per layer and overall."""
    per = results.groupBy("layer").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"))
    allr = results.agg(F.lit("overall").alias("layer"), F.count(F.lit(1)).alias("total"),
                       F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"))
    out = per.unionByName(allr)
    return out.withColumn("pass_rate", F.col("passed") / F.greatest(F.col("total"), F.lit(1)) * 100)


# ---------------------------------------------------------------- suites (Q9)
GATE_TYPES = ["Entry", "Exit", "Wide_Entry", "Wide_Exit"]


def bronze_telemetry_suite():
    return [column_exists("device_id"), column_exists("date"), column_exists("signal_strength_dbm"),
            not_null("device_id"), not_null("date"), row_count_between(100, 100000)]


def bronze_devices_suite():
    return [column_exists("device_id"), unique("device_id"), row_count_between(50, 1000)]


def silver_telemetry_suite():
    return [not_null("device_id"), not_null("date"), not_null("signal_strength_dbm", 0.99),
            between("tap_success_rate", 0, 1.0), between("signal_strength_dbm", 0, 100),
            between("temperature_c", -10, 80), between("cpu_usage_pct", 0, 100),
            between("memory_usage_pct", 0, 100), between("uptime_hours", 0, 24)]


def silver_devices_suite():
    return [unique("device_id"), not_null("station"), between("age_days", 0, 3650),
            in_set("gate_type", GATE_TYPES)]


def gold_suite():
    return [row_count_between(1000, 100000), column_exists("failure_today"), column_exists("failure_next_3d"),
            column_exists("health_score"), not_null("device_id"), not_null("health_score", 0.95),
            mean_between("failure_today", 0.02, 0.40), mean_between("failure_next_3d", 0.02, 0.50),
            between("health_score", 0, 100), between("tap_success_rate", 0, 1.0), no_infinity()]


def run_suites(bronze_t: DataFrame, bronze_d: DataFrame, silver_t: DataFrame, silver_d: DataFrame,
               gold: DataFrame) -> DataFrame:
    parts = [
        validate(bronze_t, bronze_telemetry_suite(), "bronze", "telemetry"),
        validate(bronze_d, bronze_devices_suite(), "bronze", "devices"),
        validate(silver_t, silver_telemetry_suite(), "silver", "telemetry"),
        validate(silver_d, silver_devices_suite(), "silver", "devices"),
        validate(gold, gold_suite(), "gold", "device_features"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- Q11
def quality_score(df: DataFrame, keys: list[str], ranges: dict[str, tuple], consistency: Column,
                  gate: float = 0.97) -> DataFrame:
    """Weighted score 0.4 completeness + 0.3 validity + 0.2 consistency + 0.1 uniqueness.

    completeness = non-NULL cells / all cells; validity = rows whose ranged
    columns are all NULL-or-in-range; consistency = rows satisfying the given
    predicate; uniqueness = distinct keys / rows.
    """
    ncols = len(df.columns)
    nonnull = None
    for c in df.columns:
        e = F.col(c).isNotNull().cast("int")
        nonnull = e if nonnull is None else nonnull + e
    valid = None
    for c, (lo, hi) in ranges.items():
        e = F.col(c).isNull() | F.col(c).between(lo, hi)
        valid = e if valid is None else (valid & e)
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(nonnull) / (F.count(F.lit(1)) * ncols)).alias("completeness"),
        F.avg(valid.cast("double")).alias("validity"),
        F.avg(F.coalesce(consistency, F.lit(False)).cast("double")).alias("consistency"),
        (F.count_distinct(*[F.col(k) for k in keys]) / F.count(F.lit(1))).alias("uniqueness"),
    )
    score = (0.4 * F.col("completeness") + 0.3 * F.col("validity") + 0.2 * F.col("consistency")
             + 0.1 * F.col("uniqueness"))
    return one.select("*", score.alias("quality_score"), (score >= gate).alias("gate_passed"))
