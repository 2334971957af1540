"""Sources: CSV / Parquet scans, bronze ingest, manifests, schema evolution."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- S1
def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference); a missing path gives an empty table.

    Malformed rows are kept (PERMISSIVE) with their raw text in ``corrupt_col`` when asked."""
    sch = schema
    opts = {"header": "true", "mode": "PERMISSIVE"}
    if corrupt_col:
        sch = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    try:
        return spark.read.options(**opts).schema(sch).csv(path)
    except Exception as ex:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(ex) or "does not exist" in str(ex):
            return spark.createDataFrame([], sch)
        raise


# ---------------------------------------------------------------- S2
def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All files of a bronze table, schemas merged (new columns appear, old rows get NULL)."""
    r = spark.read.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


# ---------------------------------------------------------------- S4 / S5 / B1
def with_batch_metadata(df: DataFrame, source_file: str, run_id: str | None = None, source: str = "csv") -> DataFrame:
    """Ingestion metadata: timestamp, source file, batch / run ids, source system."""
    return df.select("*", F.current_timestamp().alias("_ingested_at"), F.lit(source_file).alias("_source_file"),
                     F.lit(uuid.uuid4().hex).alias("_batch_id"), F.lit(run_id or uuid.uuid4().hex).alias("_pipeline_run_id"),
                     F.lit(source).alias("_source"))


def ingest_full(df: DataFrame, path: str, source_file: str, date_col: str | None = None,
                rows_per_file: int = 1_000_000) -> int:
    """Full bronze load: metadata + row count, one partition per day of ``date_col``
    (or one partition named by today when the table has no date)."""
    day = F.to_date(F.col(date_col)) if date_col else F.current_date()
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(day).alias("days")).first()  # two scalars
    n, days = stats["n"], max(stats["days"], 1)
    out = with_batch_metadata(df, source_file).withColumn("_row_count", F.lit(n)).withColumn("ingest_date", day)
    # one writer task per (day, salt): about rows_per_file rows per file, and a hot day is
    # spread over several tasks instead of one
    salts = max(1, -(-n // (days * rows_per_file)))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    (out.repartition("ingest_date", salt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_date").parquet(path))
    return n


def ingest_incremental(df: DataFrame, path: str, date_col: str, target_date, source_file: str) -> DataFrame:
    """Keep rows of ``target_date`` and replace only that day's partition (idempotent rerun)."""
    day = df.where(F.to_date(F.col(date_col)) == F.lit(target_date).cast("date"))
    out = with_batch_metadata(day, source_file).withColumn("ingest_date", F.lit(target_date).cast("date"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(path)
    return day


# ---------------------------------------------------------------- S7 / C1
def ingest_watermarked(spark: SparkSession, table: str, batch: DataFrame, path: str, state_path: str, date_col: str, day) -> str:
    """Decide by the stored watermark, replace the day's partition unless it is skipped, store the new
    watermark; returns the action.  The state has a version a step, so what is read is never overwritten."""
    from turnstile.operators import cdc
    from turnstile.session import path_exists

    known = spark.read.parquet(state_path) if path_exists(spark, state_path) else None
    state = (spark.createDataFrame([], cdc.WATERMARK_SCHEMA) if known is None else
             known.where(F.col("version") == known.agg(F.max("version")).first()[0]).drop("version"))
    decision = cdc.watermark_decision(state, table, batch, day)
    action = decision.first()["action"]  # one row
    if action != "skip":
        ingest_incremental(batch, path, date_col, day, f"{table}.csv")
        version = 0 if known is None else known.agg(F.max("version")).first()[0] + 1
        cdc.advance_watermark(state, decision).coalesce(1).write.parquet(f"{state_path}/version={version}")  # one row a table
    return action


# ---------------------------------------------------------------- S6 / B2
def manifest(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Files and rows per bronze table (file names from the scan itself)."""
    parts = []
    for name, path in tables.items():
        df = spark.read.parquet(path)
        parts.append(df.select(F.lit(name).alias("table_name"), F.input_file_name().alias("file")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table_name").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows"))


def batch_manifest(batch: DataFrame, watermark_before, date_col: str = "date") -> DataFrame:
    from turnstile.operators.cdc import table_hash

    after = batch.agg(F.max(date_col)).first()[0]  # one scalar
    return table_hash(batch).select(
        "row_count", "content_hash", F.lit(watermark_before).cast("date").alias("watermark_before"),
        F.lit(after).cast("date").alias("watermark_after"))


# ---------------------------------------------------------------- B3
def schema_diff(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str]]:
    """(column, change, type) for added / removed / retyped columns."""
    o = {f.name: f.dataType.simpleString() for f in old.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    out = [(c, "added", n[c]) for c in n if c not in o]
    out += [(c, "removed", o[c]) for c in o if c not in n]
    out += [(c, "retyped", f"{o[c]} -> {n[c]}") for c in n if c in o and o[c] != n[c]]
    return out
