"""Change streams (ST2) and escalation streams (ST7) whose state is written tables.

Every micro-batch writes folders of its own number, which a retry overwrites; the number comes from the stream's
checkpoint, so a restart goes on where it stopped.  What a finished step no longer reads is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.exprs import severity_rank
from turnstile.operators.patterns import consecutive_pairs
from turnstile.session import drop_path, path_exists
from turnstile.streaming.stream import _run

SEQ, DELETED = "_seq", "_deleted"


class ChangeTable:
    """A table kept by a stream of changes that may come in any order, in parts and more than once.

    A change is a row with its key, ``_seq`` (the source's sequence number of that key) and ``_deleted``.  The newest change of a key
    holds, by sequence number, not by arrival: a day split over many batches, a correction that overtakes the row it
    corrects, or a repeated delivery end in the same table.  A delete is a row too, and stays, so an older row that
    comes later doesn't bring the key back.  Two changes with the same number: the delete holds, then the row that is greater.

    A batch appends its changes, one a key.  ``compact`` merges them into new versions of the days they touch, and of no others;
    readers take each day's newest version and the changes since.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], day_col: str = "date"):
        self.spark, self.path, self.keys, self.day_col = spark, path, keys, day_col
        self.schema = T.StructType([*schema.fields, T.StructField(SEQ, T.LongType()), T.StructField(DELETED, T.BooleanType())])

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c not in (*self.keys, SEQ, DELETED)]
        last = F.max(F.struct(SEQ, DELETED, *rest)).alias("_r")  # partial per task: a hot key reaches the shuffle once a task
        return rows.groupBy(*self.keys).agg(last).select(*[F.col(c) if c in self.keys else F.col(f"_r.{c}").alias(c) for c in self.schema.names])

    def step(self, landing: str) -> int:
        """Take in what is new in the landing folder; the last batch's number."""
        def append(batch: DataFrame, epoch: int):
            batch = batch.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
            self._newest(batch).write.mode("overwrite").parquet(f"{self.path}/log/{epoch}")

        stream = self.spark.readStream.schema(self.schema).parquet(landing)
        return _run(stream.writeStream.foreachBatch(append), f"{self.path}/checkpoint")

    def _folders(self, name: str) -> list[int]:
        """Numbers of the finished folders."""
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        found = [x.getPath().getName() for x in files.listStatus(where)]
        return sorted(int(x) for x in found if path_exists(self.spark, f"{self.path}/{name}/{x}/_SUCCESS"))

    def _manifest(self) -> tuple[int, DataFrame | None]:
        """The last batch merged into versions, and the version of each day."""
        done = self._folders("manifest")
        return (done[-1], self.spark.read.parquet(f"{self.path}/manifest/{done[-1]}")) if done else (-1, None)

    def _since(self, merged: int) -> DataFrame:
        paths = [f"{self.path}/log/{n}" for n in self._folders("log") if n > merged]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _versions(self, days: DataFrame) -> DataFrame:
        """Rows of the given days' versions (days: ``day_col``, version)."""
        kept = {r[0] for r in days.select("version").distinct().collect()}  # as many as compactions still in use
        rows = None
        for n in sorted(kept):
            at = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_day", self.schema[self.day_col].dataType)])).parquet(f"{self.path}/days/{n}")
            mine = days.where(F.col("version") == n).select(F.col(self.day_col).alias("_d"))
            at = at.join(F.broadcast(mine), F.col("_day").eqNullSafe(F.col("_d")), "left_semi").select(*self.schema.names)  # one row a day
            rows = at if rows is None else rows.unionByName(at)
        return rows if rows is not None else self.spark.createDataFrame([], self.schema)

    def compact(self) -> None:
        """Merge all appended changes into new versions of their days."""
        merged, days = self._manifest()
        logged = [n for n in self._folders("log") if n > merged]
        if not logged:
            return
        upto, since = logged[-1], self._since(merged)
        touched = since.select(self.day_col).distinct()
        rows = since
        if days is not None:
            old = days.alias("o").join(touched.alias("t"), F.col(f"o.{self.day_col}").eqNullSafe(F.col(f"t.{self.day_col}")), "left_semi")
            rows = rows.unionByName(self._versions(old))
        (self._newest(rows).withColumn("_day", F.col(self.day_col)).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("_day").parquet(f"{self.path}/days/{upto}"))
        listed = touched.withColumn("version", F.lit(upto))
        if days is not None:
            rest = days.alias("o").join(touched.alias("t"), F.col(f"o.{self.day_col}").eqNullSafe(F.col(f"t.{self.day_col}")), "left_anti")
            listed = listed.unionByName(rest)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{upto}")
        used = {r[0] for r in self._manifest()[1].select("version").distinct().collect()}
        for n in logged:
            drop_path(self.spark, f"{self.path}/log/{n}")
        for n in self._folders("days"):
            if n not in used:
                drop_path(self.spark, f"{self.path}/days/{n}")

    def changes(self) -> DataFrame:
        """The newest change of every key, deletes included."""
        merged, days = self._manifest()
        rows = self._since(merged)
        return self._newest(rows if days is None else rows.unionByName(self._versions(days)))

    def read(self) -> DataFrame:
        return self.changes().where(~F.col(DELETED)).drop(SEQ, DELETED)

    def of_snapshot(self, snapshot: DataFrame, seq: int) -> DataFrame:
        """Changes of a snapshot that holds its days whole: its rows, and deletes of those days' keys that are not in it."""
        rest = [f for f in self.schema.fields if f.name not in self.keys and f.name not in (self.day_col, SEQ, DELETED)]
        days = snapshot.select(self.day_col).distinct()
        gone = (self.read().join(days, self.day_col, "left_semi").join(snapshot.select(*self.keys), self.keys, "left_anti")
                    .select(*dict.fromkeys([*self.keys, self.day_col]), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest]))
        rows = snapshot.withColumn(DELETED, F.lit(False)).unionByName(gone.withColumn(DELETED, F.lit(True)))
        return rows.withColumn(SEQ, F.lit(seq).cast("long")).select(*self.schema.names)


class EscalationTable:
    """Escalations of a stream of errors, late events within ``lateness`` included.

    Events wait in a buffer until the newest event's time less ``lateness`` has passed theirs.  Those released are paired in
    Spark, by device and hour (``consecutive_pairs``), together with the last released event of each device: a carry table of one row a device.  So a
    device that sends a third of all events is spread over its hours, and no Python state is kept.  An event that comes after its
    time was released is listed in ``late``, not dropped in silence.  A repeated delivery of a waiting event counts once.
    ``finish`` releases what still waits.
    """

    COLUMNS = ["device_id", "timestamp", "event_id", "severity", "error_code"]

    def __init__(self, errors: DataFrame, lateness: str, path: str):
        self.df, self.lateness, self.path, self.spark = errors, F.expr(f"INTERVAL {lateness}"), path, errors.sparkSession

    def _state(self, name: str, epoch: int, schema) -> DataFrame:
        at = f"{self.path}/{name}/{epoch}"
        return self.spark.read.parquet(at) if path_exists(self.spark, f"{at}/_SUCCESS") else self.spark.createDataFrame([], schema)

    def _advance(self, batch: DataFrame, epoch: int, last: bool = False) -> None:
        events = T.StructType([self.df.schema[c] for c in self.COLUMNS])
        batch = batch.select(*self.COLUMNS)
        time = self.df.schema["timestamp"].dataType
        mark = self._state("mark", epoch - 1, T.StructType([T.StructField("newest", time), T.StructField("released", time)]))
        newest = mark.select("newest").unionByName(batch.select(F.max("timestamp").alias("newest"))).agg(F.max("newest").alias("newest"))
        released = F.lit(None).cast(time) if last else F.col("newest") - self.lateness
        newest.withColumn("released", released.cast(time)).write.mode("overwrite").parquet(f"{self.path}/mark/{epoch}")
        before = (mark.first() or (None, None))[1]  # one row
        upto = self.spark.read.parquet(f"{self.path}/mark/{epoch}").first()["released"]
        late = F.lit(False) if before is None else F.col("timestamp") < F.lit(before)
        batch.where(late).write.mode("overwrite").parquet(f"{self.path}/late/{epoch}")
        waiting = batch.where(~late | F.col("timestamp").isNull()).unionByName(self._state("buffer", epoch - 1, events)).dropDuplicates(["device_id", "timestamp", "event_id"])
        free = F.lit(True) if last else (F.lit(False) if upto is None else F.col("timestamp") < F.lit(upto))
        waiting.where(~F.coalesce(free, F.lit(False))).write.mode("overwrite").parquet(f"{self.path}/buffer/{epoch}")
        carry = self._state("carry", epoch - 1, events)
        now = waiting.where(free).unionByName(carry)
        pairs = consecutive_pairs(now, ["timestamp", "severity", "error_code"])
        (pairs.where(severity_rank("next_severity") > severity_rank("severity"))
              .select("device_id", F.col("timestamp").alias("ts"), F.col("severity").alias("from_severity"), F.col("next_severity").alias("to_severity"),
                      F.col("error_code").alias("from_error"), F.col("next_error_code").alias("to_error"))
              .write.mode("overwrite").parquet(f"{self.path}/out/{epoch}"))
        rest = [c for c in self.COLUMNS if c not in ("device_id", "timestamp", "event_id")]
        newest_event = F.max(F.struct("timestamp", "event_id", *rest)).alias("e")
        now.groupBy("device_id").agg(newest_event).select("device_id", *[F.col(f"e.{c}") for c in self.COLUMNS[1:]]) \
           .write.mode("overwrite").parquet(f"{self.path}/carry/{epoch}")
        for name in ("mark", "buffer", "carry"):  # a retry of this batch needs the state before it
            drop_path(self.spark, f"{self.path}/{name}/{epoch - 2}")

    def step(self) -> int:
        self.epoch = _run(self.df.writeStream.foreachBatch(self._advance), f"{self.path}/checkpoint")
        return self.epoch

    def finish(self) -> None:
        """Release all waiting events; no step may follow."""
        batches = [int(p) for p in self._numbers("carry")]
        if batches:
            self._advance(self.spark.createDataFrame([], self.df.schema), max(batches) + 1, last=True)

    def _numbers(self, name: str) -> list[str]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []

    def _all(self, name: str, schema) -> DataFrame:
        paths = [f"{self.path}/{name}/{n}" for n in self._numbers(name)]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._all("out", "device_id long, ts timestamp, from_severity string, to_severity string, from_error string, to_error string")

    def late(self) -> DataFrame:
        return self._all("late", T.StructType([self.df.schema[c] for c in self.COLUMNS]))
