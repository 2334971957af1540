"""Driver tables: one parquet file per table under an ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_READS: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (the lazy plan is reused per session)."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READS[key] = df
    return df


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
