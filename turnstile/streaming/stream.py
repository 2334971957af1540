"""Structured Streaming variants (ST1, ST3-ST6; ST2 and ST7 are in ``changes``).

Every aggregation here is written once as a DataFrame -> DataFrame function
that works on a batch DataFrame and on a streaming one (``window`` +
``withWatermark``), so the batch run is the reference for the stream run.
Checkpoints and sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.stats import bucketed_prefix_sums
from turnstile.session import drop_path, path_exists, scratch_path


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): reinterpret in the session zone (UTC)."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def _run(writer, checkpoint: str) -> int:
    """Process what is new (availableNow) and return the last batch's number."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q.lastProgress["batchId"] if q.lastProgress else -1


# ---------------------------------------------------------------- ST1
def ingest_stream(spark: SparkSession, landing: str, schema, bronze: str, checkpoint: str,
                  source_name: str = "events") -> int:
    """Incremental file ingest to bronze: every new landing file is read once (checkpointed
    offsets), stamped with batch metadata and written by batch and day.  A batch has a folder
    of its own that a retry overwrites, so no batch is counted twice."""
    s = spark.readStream.schema(schema).parquet(landing)

    def write(batch: DataFrame, epoch: int):
        (batch.withColumn("_ingested_at", F.current_timestamp())
         .withColumn("_source", F.lit(source_name))
         .withColumn("date", F.to_date("ts"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("date").parquet(f"{bronze}/batch={epoch}"))

    return _run(s.writeStream.foreachBatch(write), checkpoint)


# ---------------------------------------------------------------- ST3 / ST5 / ST6
def tumbling_device_counts(events: DataFrame, minutes: int = 15, lateness: str | None = None) -> DataFrame:
    """Per device and tumbling window: events, errors, error rate."""
    e = event_time(events)
    if lateness and e.isStreaming:
        e = e.withWatermark("ts", lateness)
    g = e.groupBy("user_id", F.window("ts", f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return g.select(F.col("user_id").alias("device_id"), F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "events", "errors",
                    (F.col("errors") / F.col("events")).alias("error_rate"))


#: Size of a latency sketch: quantiles are off by 1.33 % of the rows at most (with 99 % confidence), whatever their number.
SKETCH_K, RANK_ERROR = 200, 0.0133


def minute_sketches(requests: DataFrame, lateness: str | None = None) -> DataFrame:
    """One row a minute: requests, failures, sum and maximum of the latency, and a KLL sketch of it; wider windows merge these rows."""
    r = event_time(requests)
    if lateness and r.isStreaming:
        r = r.withWatermark("ts", lateness)
    ms = F.col("duration_ms").cast("double")
    g = r.groupBy(F.window("ts", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("success")).alias("failures"), F.count(ms).alias("measured"), F.sum(ms).alias("sum_ms"),
        F.max(ms).alias("max_ms"), F.kll_sketch_agg_double(ms, F.lit(SKETCH_K)).alias("sketch"))
    return g.select(F.col("w.start").alias("minute"), "requests", "failures", "measured", "sum_ms", "max_ms", "sketch")


def merged_windows(minutes: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Metrics of wider windows, tumbling or sliding, from ``minute_sketches``: no request is read again."""
    w = F.window("minute", window, slide) if slide else F.window("minute", window)
    g = minutes.groupBy(w.alias("w")).agg(
        F.sum("requests").alias("requests"), F.sum("failures").alias("failures"), (F.sum("sum_ms") / F.sum("measured")).alias("avg_ms"),
        F.max("max_ms").alias("max_ms"), F.sum("measured").alias("measured"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))

    def quantile(q):
        return F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))

    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "failures",
                    (F.col("failures") / F.col("requests")).alias("error_rate"), "avg_ms", "max_ms",
                    quantile(0.5).alias("p50_ms"), quantile(0.95).alias("p95_ms"), quantile(0.99).alias("p99_ms"))


def counted_percentiles(requests: DataFrame, window: Column, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles of the latency by window (the smallest value that so many of the rows don't exceed), one row a window.

    Equal values of a window are counted first; running counts go over range buckets (``bucketed_prefix_sums``), so no window's values meet in one task."""
    values = (event_time(requests).where(F.col("duration_ms").isNotNull()).groupBy(window.alias("w"), F.col("duration_ms").cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "v", "n"))
    run = bucketed_prefix_sums(values, ["window_start", "window_end"], "v", ["n"])
    total = run.groupBy("window_start").agg(F.sum("n").alias("total"))
    run = run.join(total, "window_start")
    return run.groupBy("window_start", "window_end").agg(
        *[F.min(F.when(F.col("cum_n") >= F.ceil(F.lit(q) * F.col("total")), F.col("v"))).alias(name) for name, q in shares.items()])


def request_metrics(requests: DataFrame, minutes: int = 1, lateness: str | None = None) -> DataFrame:
    """Per time bin: request count, failures, error rate, mean/max latency, latency percentiles.

    Percentiles are exact over a table; over a stream they come from a KLL sketch (within ``RANK_ERROR``)."""
    r = event_time(requests)
    if lateness and r.isStreaming:
        r = r.withWatermark("ts", lateness)
    window = F.window("ts", f"{minutes} minutes")
    aggs = [F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("success")).alias("failures"),
            F.avg("duration_ms").alias("avg_ms"), F.max("duration_ms").alias("max_ms")]
    shares = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    if r.isStreaming:
        aggs.append(F.kll_sketch_agg_double(F.col("duration_ms").cast("double"), F.lit(SKETCH_K)).alias("sketch"))
        g = r.groupBy(window.alias("w")).agg(*aggs).select("*", F.col("w.start").alias("window_start"), *[
            F.when(F.col("max_ms").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(c) for c, q in shares.items()])
    else:
        g = r.groupBy(window.alias("w")).agg(*aggs).withColumn("window_start", F.col("w.start"))
        g = g.join(counted_percentiles(r, window, shares).drop("window_end"), "window_start", "left")
    return g.select("window_start", "requests", "failures", (F.col("failures") / F.col("requests")).alias("error_rate"), "avg_ms", "max_ms", *shares)


def anomaly_rate(requests: DataFrame, minutes: int = 60, lateness: str | None = None) -> DataFrame:
    """Per time bin: requests, anomalies (flag ``is_anomaly``) and their share."""
    r = event_time(requests)
    if lateness and r.isStreaming:
        r = r.withWatermark("ts", lateness)
    g = r.groupBy(F.window("ts", f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("is_anomaly").alias("anomalies"))
    return g.select(F.col("w.start").alias("window_start"), "requests", "anomalies",
                    (F.col("anomalies") / F.col("requests")).alias("anomaly_rate"))


def requests_by_name(requests: DataFrame) -> DataFrame:
    return requests.groupBy("name").agg(F.count(F.lit(1)).alias("requests"),
                                        F.avg((~F.col("success")).cast("double")).alias("error_rate"))


def sliding_alerts(requests: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                   max_error_rate: float = 0.1, max_p99_ms: float = 1000.0, lateness: str | None = None) -> DataFrame:
    """Alert rows for sliding windows whose error rate or p99 latency breaks a limit (p99 as in ``request_metrics``)."""
    r = event_time(requests)
    if lateness and r.isStreaming:
        r = r.withWatermark("ts", lateness)
    w = F.window("ts", window, slide)
    aggs = [F.count(F.lit(1)).alias("requests"), F.avg((~F.col("success")).cast("double")).alias("error_rate")]
    if r.isStreaming:
        g = r.groupBy(w.alias("w")).agg(*aggs, F.count("duration_ms").alias("measured"),
                                        F.kll_sketch_agg_double(F.col("duration_ms").cast("double"), F.lit(SKETCH_K)).alias("sketch"))
        g = g.withColumn("p99_ms", F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.99))))
        g = g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "error_rate", "p99_ms")
    else:
        g = r.groupBy(w.alias("w")).agg(*aggs).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "error_rate")
        g = g.join(counted_percentiles(r, w, {"p99_ms": 0.99}), ["window_start", "window_end"], "left")
    alerts = F.filter(F.array(
        F.when(F.col("error_rate") > max_error_rate, F.lit("error_rate")),
        F.when(F.col("p99_ms") > max_p99_ms, F.lit("p99_latency"))), lambda x: x.isNotNull())
    return g.select("window_start", "window_end", "requests", "error_rate", "p99_ms", alerts.alias("alerts")).where(F.size("alerts") > 0)


def metric_alerts(values: DataFrame) -> DataFrame:
    """Threshold alerts on scalar monitoring metrics (drift share, quality, at-risk devices)."""
    rules = [("drift_share", ">", 0.30), ("quality_pass_rate", "<", 90.0), ("devices_at_risk", ">", 20.0)]
    cond = None
    for name, op, v in rules:
        c = (F.col("metric") == name) & ((F.col("value") > v) if op == ">" else (F.col("value") < v))
        cond = c if cond is None else (cond | c)
    return values.where(cond)


# ---------------------------------------------------------------- ST4
def dedup_stream(events: DataFrame, keys: list[str], lateness: str = "1 hour") -> DataFrame:
    """Drop re-delivered events (same key) that arrive within the lateness bound."""
    e = event_time(events)
    if e.isStreaming:
        return e.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)
    return e.dropDuplicates(keys)


class StreamTable:
    """A streaming query's result as a table: a folder for each batch, which a retry overwrites.

    ``step`` processes what is new and may be called again, after a restart as well.  In update
    mode ``read`` gives each key's newest row."""

    def __init__(self, stream_df: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None, path: str | None = None):
        self.df, self.mode, self.keys = stream_df, mode, keys
        self.path = path or scratch_path(stream_df.sparkSession, f"stream/{name}-{uuid.uuid4().hex}")

    def step(self) -> int:
        def write(batch: DataFrame, epoch: int):
            batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/out/epoch={epoch}")

        return _run(self.df.writeStream.outputMode(self.mode).foreachBatch(write), f"{self.path}/checkpoint")

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the finished folders."""
        spark = self.df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName().removeprefix("epoch=") for x in files.listStatus(where)] if files.exists(where) else []
        at = f"{self.path}/{name}/" + ("epoch=" if name == "out" else "")
        return sorted(int(x) for x in names if x.isdigit() and path_exists(spark, f"{at}{x}/_SUCCESS"))

    def _newest(self) -> DataFrame:
        """Each key's newest row with its batch: the last merged table and the batches since."""
        spark = self.df.sparkSession
        merged = self._numbers("merged")
        done = merged[-1] if merged else -1
        schema = T.StructType([*self.df.schema.fields, T.StructField("epoch", T.LongType())])
        rows = spark.read.parquet(f"{self.path}/merged/{done}") if merged else spark.createDataFrame([], schema)
        for n in self._numbers("out"):
            if n > done:
                rows = rows.unionByName(spark.read.parquet(f"{self.path}/out/epoch={n}").select(*self.df.columns, F.lit(n).cast("long").alias("epoch")))
        rest = [c for c in self.df.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "epoch"), "epoch").alias("_r")).select(
            *self.keys, *[F.col(f"_r.{c}").alias(c) for c in (*rest, "epoch")]).select(*self.df.columns, "epoch")

    def compact(self) -> None:
        """Update mode: merge all batches into one table of a row a key; ``read`` then scans that and later batches alone."""
        batches = self._numbers("out")
        older = self._numbers("merged")
        if self.mode == "append" or not batches or older and batches[-1] <= older[-1]:
            return
        self._newest().write.mode("overwrite").parquet(f"{self.path}/merged/{batches[-1]}")
        for n in batches:
            drop_path(self.df.sparkSession, f"{self.path}/out/epoch={n}")
        for n in older:
            drop_path(self.df.sparkSession, f"{self.path}/merged/{n}")

    def read(self) -> DataFrame:
        spark = self.df.sparkSession
        if not path_exists(spark, f"{self.path}/out"):
            return spark.createDataFrame([], self.df.schema)
        if self.mode == "append":
            return spark.read.parquet(f"{self.path}/out").select(*self.df.columns)
        return self._newest().drop("epoch")


def land_in_order(rows: DataFrame, landing: str, parts: list, step) -> None:
    """Deliver ``rows`` in several parts (conditions), each followed by ``step()``: a stream that gets
    its files over time and is stopped and started between them."""
    for condition in parts:
        rows.where(condition).write.mode("append").parquet(landing)
        step()
