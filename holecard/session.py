"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs:
AQE on (runtime coalescing and skew-join splitting), a session time zone, and a
checkpoint folder.  The checkpoint folder is read from ``spark.checkpoint.dir``;
only a local-mode session with no setting gets a scratch folder of its own.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT = None


def build_session(master: str | None = None, app_name: str = "holecard",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value is
    used as is.  Only when it is unset *and* the master is local (tests, bench)
    is a scratch folder created.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    if _LOCAL_CHECKPOINT_ROOT is None:
        _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="holecard-ckpt-")
    path = os.path.join(_LOCAL_CHECKPOINT_ROOT, "checkpoints")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Functions that run in tasks are pickled by name, so a session that was
    started without the package (no ``--py-files``, no install on the workers)
    gets it as a zip over the driver's file server, once per context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_holecard_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="holecard-py-"), "holecard.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._holecard_shipped = True


def prepare(spark: SparkSession) -> None:
    """What every registered query needs of a session, whoever started it."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def checkpoint_stage(df):
    """Write ``df`` once to the checkpoint folder and continue from there.

    The rows are persisted first: a reliable checkpoint otherwise computes the
    plan twice (once for the eager count, once more to write the files).
    After the checkpoint is written the cache is released; later stages read
    the checkpoint files, which also survive lost executors.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def scratch_path(spark, name: str) -> str:
    """A new path in the checkpoint folder, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def write_table(df, name: str = "table", partition_by: tuple = ()):
    """Write ``df`` as Parquet into the checkpoint folder and read it again.

    Like a checkpoint it cuts the lineage and survives lost executors, but the
    rows are computed once without a copy in executor memory, and only the
    columns that are used later are read, of ``partition_by`` only the values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_freed(spark):
    """Shuffle files of every query that runs inside go when it ends, not when
    the driver happens to collect its garbage; for steps that each write a table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
