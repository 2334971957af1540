"""SparkSession construction and cluster-facing helpers.

On a cluster the session is created by the platform; ``get_session`` only
builds one for local runs and tests.  Everything else in the package takes a
session (or a DataFrame) and never assumes local mode.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "turnstile") -> SparkSession:
    """Local/test session: UTC, AQE on, ANSI left on, no UI."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("TURNSTILE_SHUFFLE_PARTITIONS", cpus))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("TURNSTILE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.python.worker.reuse", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (as ``--py-files`` would).

    Functions are pickled by module name, so executors must be able to import the
    package wherever the driver was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_turnstile_shipped", None):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="turnstile-py-"), "turnstile.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._turnstile_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared (HDFS/object store) path and
    we only read it.  Only when it is unset (tests, local runs) do we create a
    scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not readable as a session conf
            conf_dir = None
    if not conf_dir:
        # local runs / tests only: the cluster names a shared folder in spark.checkpoint.dir
        # (a core config, fixed at start-up, so it is not set here)
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="turnstile-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables, inside the run's own if there is one."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *_runs[-1:], name])


#: Folders of the runs begun and not ended, the innermost last.
_runs: list[str] = []


@contextmanager
def scratch_run(spark: SparkSession):
    """Intermediate tables written inside go to one folder, which is removed at the end, also after an error.

    Results must be written (or collected) inside, since they read the intermediate tables.  Tables that
    earlier queries keep for the next ones are neither used nor removed.  One run at a time in a driver, or
    one inside another."""
    from turnstile.sources.canonical import Fleet

    kept, Fleet._cache = Fleet._cache, {}
    _runs.append(f"runs/{uuid.uuid4().hex}")
    folder = scratch_path(spark, "").rstrip("/")
    try:
        yield folder
    finally:
        _runs.pop()
        Fleet._cache = kept
        drop_path(spark, folder)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    This is the medallion hand-off (a layer is written once, the next layer
    reads it): lineage is cut, a lost executor only re-reads files, and readers
    get column pruning and predicate pushdown on the written table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its file system (any that Spark can reach)."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def mkdirs(spark: SparkSession, path: str) -> None:
    """Create a folder, for a stream that starts before its first file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and no longer reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
