"""Streaming variants equal their batch definitions."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_stream_tumbling_equals_batch(spark):
    q = E.queries()
    a = {tuple(r) for r in q["st3_stream_tumbling"](spark, SF_SMALL).collect()}
    b = {tuple(r) for r in q["st3_tumbling_counts"](spark, SF_SMALL).collect()}
    assert a == b and len(a) > 0


def test_stateful_escalations_equal_batch(spark):
    q = E.queries()
    a = q["st7_escalation_stream"](spark, SF_SMALL)
    b = q["w10_escalations"](spark, SF_SMALL).withColumnRenamed("timestamp", "ts")
    assert a.count() == b.count()
    assert a.select("device_id", "ts").exceptAll(b.select("device_id", F.col("ts").cast("timestamp_ntz"))).count() == 0


def test_stream_dedup(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = E.queries()["st4_dedup_stream"](spark, SF_SMALL).agg(F.sum("events")).first()[0]
    assert got == ev.count()
