"""Silver layer: standardise, dedupe, clip, fill, quarantine.

Dedup keeps the latest delivery per key with ``max_by`` inside a grouped
aggregation: partial aggregation runs map-side, so a key that is delivered
millions of times is reduced before the shuffle instead of being sorted in one
task (which a ``row_number`` window would do).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.exprs import (
    DEVICE_RANGES,
    MAINTENANCE_RANGES,
    TELEMETRY_RANGES,
    VALID_SEVERITIES,
    clip_keep_null,
    std_title,
    std_upper,
)
from turnstile.functions.stats import exact_median
from turnstile.session import materialize


# ---------------------------------------------------------------- P1
def drop_meta(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


# ---------------------------------------------------------------- W7 / W8
def dedup_latest(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Keep the latest row per key (by ``order_cols``, default ``_ingested_at``,
    ties broken by the remaining columns so the winner is deterministic)."""
    order_cols = order_cols or ["_ingested_at"]
    rest = [c for c in df.columns if c not in keys]
    rank_key = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest if c not in order_cols])
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), rank_key).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


# ---------------------------------------------------------------- P2
def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Safe casts (``try_cast``): unparsable values become NULL instead of failing the job."""
    return df.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def cast_rejects(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Rows whose non-NULL value fails a cast (for the quarantine table)."""
    bad = None
    for c, t in casts.items():
        cond = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        bad = cond if bad is None else (bad | cond)
    return df.where(bad) if bad is not None else df.limit(0)


# ---------------------------------------------------------------- P4
def clip_ranges(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    return df.select(*[clip_keep_null(c, *ranges[c]).cast(df.schema[c].dataType).alias(c) if c in ranges
                       else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- P6 / P7
NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def fill_median(df: DataFrame, cols: list[str] | None = None, medians: dict | None = None) -> DataFrame:
    """Fill NULLs with the whole-column exact median (computed distributed)."""
    cols = cols if cols is not None else numeric_columns(df)
    need = [c for c in cols]
    med = medians if medians is not None else exact_median(df, need)
    out = []
    for c in df.columns:
        if c in need and med.get(c) is not None:
            out.append(F.coalesce(F.col(c), F.lit(med[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


# ---------------------------------------------------------------- tables
def clean_devices(df: DataFrame) -> DataFrame:
    d = dedup_latest(df, ["device_id"]) if "_ingested_at" in df.columns else df
    d = drop_meta(d)
    d = d.select(*[std_title(c).alias(c) if c in ("gate_type", "manufacturer", "station") else F.col(c)
                   for c in d.columns])
    return clip_ranges(d, DEVICE_RANGES)


def clean_telemetry(df: DataFrame, medians: dict | None = None) -> DataFrame:
    d = dedup_latest(df, ["device_id", "date"]) if "_ingested_at" in df.columns else df
    d = drop_meta(d)
    d = clip_ranges(d, TELEMETRY_RANGES)
    if medians is None:
        d = materialize(d, "telemetry-clipped")  # read by every pass of the medians and by the result
    return fill_median(d, numeric_columns(d, exclude=("device_id",)), medians)


def clean_error_logs(df: DataFrame) -> DataFrame:
    d = drop_meta(df)
    d = d.select(*[std_upper(c).alias(c) if c in ("severity", "error_code") else F.col(c) for c in d.columns])
    d = d.where(F.col("severity").isin(VALID_SEVERITIES))
    return d.fillna({"resolution_time_min": -1.0})


def clean_maintenance(df: DataFrame) -> DataFrame:
    d = drop_meta(df)
    d = d.select(*[std_title(c).alias(c) if c == "maintenance_type" else F.col(c) for c in d.columns])
    return clip_ranges(d, MAINTENANCE_RANGES)


# ---------------------------------------------------------------- Q12 / B4 / J14
def quarantine(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, rejected); a rejected row carries every failed rule.

    ``rules``: name -> (condition that a VALID row satisfies, reason text).
    NULL conditions count as failures.
    """
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.struct(F.lit(n).alias("rule"), F.lit(r).alias("reason")))
                  for n, (cond, r) in rules.items()]),
        lambda x: x.isNotNull())
    tagged = df.withColumn("_failed", failed)
    valid = tagged.where(F.size("_failed") == 0).drop("_failed")
    rejected = tagged.where(F.size("_failed") > 0).select(
        *df.columns,
        F.col("_failed")[0]["rule"].alias("rejection_rule"),
        F.array_join(F.transform("_failed", lambda x: x["reason"]), "; ").alias("rejection_reason"),
        F.size("_failed").alias("failed_rules"),
    )
    return valid, rejected


def orphans(child: DataFrame, parent: DataFrame, key: str = "device_id") -> DataFrame:
    """Rows of ``child`` whose key has no parent row (anti join)."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def null_rules(df: DataFrame, rules: dict[str, str], medians: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Per-column NULL policy: 'reject' | 'median' | 'unknown' | 'zero' (B4)."""
    reject = [c for c, r in rules.items() if r == "reject"]
    valid, rejected = quarantine(df, {f"not_null_{c}": (F.col(c).isNotNull(), f"{c} is NULL") for c in reject}) \
        if reject else (df, df.limit(0))
    med_cols = [c for c, r in rules.items() if r == "median"]
    if med_cols:
        valid = fill_median(valid, med_cols, medians)
    fills = {c: "UNKNOWN" for c, r in rules.items() if r == "unknown"}
    fills.update({c: 0 for c, r in rules.items() if r == "zero"})
    return valid.fillna(fills), rejected


def enum_map(df: DataFrame, col: str, mapping: DataFrame, key: str = "raw", value: str = "canonical",
             default: str | None = None) -> DataFrame:
    """Seed/lookup join (B5): replace ``col`` by its canonical value.

    The seed table is a hand-maintained list (bounded), so it is broadcast.
    """
    m = F.broadcast(mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v")))
    j = df.join(m, F.col(col) == F.col("_k"), "left")
    fill = F.lit(default) if default is not None else F.col(col)
    return j.select(*[F.coalesce(F.col("_v"), fill).alias(c) if c == col else F.col(c) for c in df.columns])
