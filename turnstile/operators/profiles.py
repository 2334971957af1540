"""Column profiles and checks from stored states that merge.

A state is one row a (day, column) of a table: counts, the smallest and largest value, mean and sum of
squared deviations, a HyperLogLog sketch of the distinct values and a KLL sketch of the numbers.  States
merge: of a day's parts into the day, of days into weeks, of all days into the table's profile.  A new day is
read once; what came before is not read again.

Defined cases: NULLs and NaNs are counted apart and are in no other figure; infinities count as values of
low and high, and apart, and are in no mean, deviation or quantile.  A NULL day is a day of its own.  A column
without values has NULL figures and 0 distinct values.  An empty table has no states and no profile rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.operators.quality import NUMERIC, Expectation
from turnstile.session import path_exists

#: log2 of HyperLogLog's registers: standard error 1.6 %.
HLL_K = 12
#: KLL's k: rank error 1.33 % at 99 % confidence.
KLL_K = 200

COUNTS = ["rows", "nulls", "nans", "infinite", "finite"]


def _kinds(df: DataFrame, day: str) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name != day]


def column_states(df: DataFrame, day: str) -> DataFrame:
    """States by (day, column) in one aggregation: every column's figures side by side, then a row a column.

    The table is shuffled only as partial figures, one row a task and day."""
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(_kinds(df, day)):
        c, p = F.col(f"`{f.name}`"), f"c{i}_"
        aggs.append(F.count(c).alias(p + "filled"))
        nans = infinite = F.lit(0).cast("long")
        low = high = mean = m2 = F.lit(None).cast("double")
        quantiles = F.lit(None).cast("binary")
        finite, distinct = F.lit(0).cast("long"), c
        if isinstance(f.dataType, NUMERIC):
            x = c.cast("double")
            real = F.when(~F.isnan(x), x)
            plain = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
            aggs += [F.count_if(F.isnan(x)).alias(p + "nans"), F.count_if(F.abs(x) == float("inf")).alias(p + "infinite"),
                     F.min(real).alias(p + "low"), F.max(real).alias(p + "high"), F.count(plain).alias(p + "finite"),
                     F.avg(plain).alias(p + "mean"), F.var_pop(plain).alias(p + "var"),
                     F.kll_sketch_agg_double(plain, F.lit(KLL_K)).alias(p + "quantiles")]
            nans, infinite, low, high, mean, finite, quantiles = (F.col(p + n) for n in ("nans", "infinite", "low", "high", "mean", "finite", "quantiles"))
            m2 = F.col(p + "var") * finite
            distinct = real + F.lit(0.0)  # one zero
        aggs.append(F.hll_sketch_agg(F.when(distinct.isNotNull(), F.xxhash64(distinct)), F.lit(HLL_K)).alias(p + "distinct"))
        rows.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col("rows"),
            (F.col("rows") - F.col(p + "filled")).alias("nulls"), nans.alias("nans"), infinite.alias("infinite"), finite.alias("finite"),
            low.alias("low"), high.alias("high"), mean.alias("mean"), m2.alias("m2"),
            F.col(p + "distinct").alias("distinct"), quantiles.alias("quantiles")))
    wide = df.groupBy(F.col(f"`{day}`").alias("day")).agg(*aggs)
    return wide.select("day", F.explode(F.array(*rows)).alias("s")).select("day", "s.*")


def _merged_moments(states: Column) -> Column:
    """Mean and squared deviations of the union of ``states``, taken in one after the other."""
    def step(a, s):
        n = a["n"] + s["finite"]
        d = s["mean"] - a["mean"]
        return F.when(s["finite"] == 0, a).otherwise(F.struct(
            n.alias("n"), (a["mean"] + d * s["finite"] / n).alias("mean"),
            (a["m2"] + s["m2"] + d * d * a["n"] * s["finite"] / n).alias("m2")))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(states, zero, step)


def merge_states(states: DataFrame, by: list | None = None) -> DataFrame:
    """States of the union, by ``by`` (columns such as the day or its week; none: the whole table) and column.

    A group holds a column's states of the days (and parts of days) that it joins, as many as the calendar
    has, whatever the rows of the table.  Merging is associative: the result can be merged again."""
    keys = [*(by or []), "column", "dtype"]
    g = states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("low").alias("low"), F.max("high").alias("high"),
        F.array_sort(F.collect_list(F.struct("finite", "mean", "m2"))).alias("parts"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))
    g = g.withColumn("m", _merged_moments(F.col("parts")))
    some = F.col("finite") > 0
    return g.withColumns({"mean": F.when(some, F.col("m.mean")), "m2": F.when(some, F.col("m.m2"))}).drop("parts", "m")


def profile_of(states: DataFrame, by: list | None = None) -> DataFrame:
    """A11 from states: counts, extremes, mean and deviation are those of one pass over the rows; the number of
    distinct values (standard error 1.6 %) and the quantiles (rank error 1.33 %) are estimates."""
    m = merge_states(states, by)
    keys = m.columns[:len(by or [])]

    def quantile(q):
        return F.when(F.col("finite") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))

    return m.select(
        *keys, "column", "dtype", *COUNTS, (F.col("nulls") / F.col("rows")).alias("null_pct"), "low", "high", "mean",
        F.when(F.col("finite") > 1, F.sqrt(F.col("m2") / (F.col("finite") - 1))).alias("std"),
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"),
        quantile(0.5).alias("p50"), quantile(0.95).alias("p95"), quantile(0.99).alias("p99"))


class ProfileStore:
    """States of a table that grows by batches, as Parquet by batch.

    A batch is a set of rows with an id: a day, a part of a day, or several days.  Delivered again, it replaces
    what it wrote before (dynamic partition overwrite), so a restarted load counts nothing twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, day: str, batch: str) -> None:
        (column_states(df, day).withColumn("batch", F.lit(batch))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path))

    def states(self) -> DataFrame | None:
        """All states, or None before the first batch."""
        return self.spark.read.parquet(self.path).drop("batch") if path_exists(self.spark, self.path) else None


def validate_states(states: DataFrame, exps: list[Expectation], layer: str, table: str) -> DataFrame:
    """Q9 from states: layer, table, check_id, expectation, success, observed, as ``quality.validate`` gives them
    for a table without NaNs.  ``unique`` and ``in_set`` need the values themselves and are refused."""
    refused = sorted({e.kind for e in exps} & {"unique", "in_set"})
    if refused:
        raise ValueError(f"states can't tell {', '.join(refused)}")
    m = merge_states(states)
    one = m.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct(
        "rows", "nulls", "infinite", "finite", "low", "high", "mean")))).alias("s"), F.max("rows").alias("n"))
    rows = []
    for i, e in enumerate(exps):
        s = F.col("s")[e.column] if e.column else None
        if e.kind == "column_exists":
            ok = s.isNotNull()
            seen = F.when(ok, 1.0).otherwise(0.0)
        elif e.kind == "not_null":
            seen = s["nulls"] / s["rows"]
            ok = (F.lit(1.0) - seen) >= float(e.args[0])
        elif e.kind == "between":
            seen = s["high"]
            ok = (s["low"] >= float(e.args[0])) & (seen <= float(e.args[1]))
        elif e.kind == "mean_between":
            seen = s["mean"]
            ok = seen.between(float(e.args[0]), float(e.args[1]))
        elif e.kind == "row_count_between":
            seen = F.coalesce("n", F.lit(0))
            ok = seen.between(*e.args)
        elif e.kind == "no_infinity":
            seen = F.aggregate(F.map_values("s"), F.lit(0).cast("long"), lambda a, x: a + x["infinite"])
            ok = seen == 0
        else:
            raise ValueError(e.kind)
        rows.append(F.struct(
            F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit(i).alias("check_id"), F.lit(e.describe()).alias("expectation"),
            F.coalesce(ok, F.lit(False)).alias("success"), seen.cast("double").alias("observed")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
