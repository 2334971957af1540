"""Sinks (S8-S13): Parquet / CSV tables, JSON documents, feature-set exports,
daily prediction snapshots and the serving read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def to_json_document(df: DataFrame, col: str = "doc") -> DataFrame:
    """One JSON string per row (nested structs / arrays / maps kept)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(col))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def export_feature_sets(gold: DataFrame, root: str) -> dict[str, str]:
    """One Parquet table per named feature set."""
    from turnstile.operators.store import FEATURE_SETS, feature_set

    out = {}
    for name in FEATURE_SETS:
        p = f"{root}/{name}"
        write_parquet(feature_set(gold, name), p)
        out[name] = p
    return out


# Columns of the daily snapshot.
LATEST_COLUMNS = ["device_id", "failure_probability", "failure_risk_tier", "anomaly_label", "anomaly_score",
                  "rul_median_days", "sla_risk_tier", "sla_risk_score"]


def prediction_snapshot(preds: DataFrame, root: str, run_date) -> DataFrame:
    """Full predictions by run date, the 8-column 'latest' CSV, a JSON summary; the CSV read back."""
    missing = [c for c in LATEST_COLUMNS if c not in preds.columns]
    if missing:
        raise ValueError(f"predictions lack {missing}")
    write_parquet(preds.withColumn("run_date", F.lit(run_date).cast("date")), f"{root}/history", ["run_date"])
    latest = preds.select(*LATEST_COLUMNS)
    write_csv(latest, f"{root}/latest")
    summary = preds.agg(F.count(F.lit(1)).alias("devices"),
                        F.count_if(F.col("failure_risk_tier").isin("HIGH", "CRITICAL")).alias("high_risk"),
                        F.avg("rul_median_days").alias("mean_rul"))
    write_json(to_json_document(summary.withColumn("run_date", F.lit(str(run_date)))), f"{root}/summary")
    return preds.sparkSession.read.schema(latest.schema).option("header", "true").csv(f"{root}/latest")


def serving_read(df: DataFrame) -> DataFrame:
    """Records for an API: NULL -> 0 and +/-infinity -> 0 in numeric columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(c.isNull() | (F.abs(c) == float("inf")) | F.isnan(c), F.lit(0.0)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
