"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # raw rows hold whole documents (~0.3 MB as VARIANT); a vectorized batch of the default
    # 4096 rows would reserve over 1 GB per task. 256 rows bounds it; narrow scans are not
    # slower.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    # checked broadcasts checkpoint small frames; remove their files once unreferenced
    # (a scheduled ingest would otherwise accumulate them)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: The shuffle files of a write go when the write ends. Else they stay until the driver happens to
#: collect its garbage, and a job of many writes holds the files of all of them.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def get_spark(master: str | None = None, app: str = "airlake",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster pass ``master=None`` and let spark-submit decide; shuffle partitions
    then stay at the cluster's value and AQE coalesces them at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; the session's own come back after."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only where it is unset and the session is local
    (tests) a folder of our own is created and registered; on a cluster an unset setting
    is an error, never a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = getattr(spark, "_sc", None)                            # absent on a remote (Connect) session
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares "
                               "(a machine-local folder does not survive on a cluster)")
        base = tempfile.mkdtemp(prefix="airlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        sc.setCheckpointDir(base)
    if sc is not None and not sc.master.startswith("local") and base.startswith("file:"):
        raise RuntimeError("spark.checkpoint.dir is a machine-local folder; on a cluster it must be one "
                           "that every executor shares")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)                               # a conf set after start-up
    path = "/".join([base.rstrip("/"), *parts])
    if sc is not None:
        fs, there = file_system(spark, path)
        fs.mkdirs(there)                                        # in the folder's own file system
    return path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this library has written; nothing happens if it is not there."""
    fs, there = file_system(spark, path)
    fs.delete(there, True)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None if nothing has been written yet. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scale_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the expected largest shuffle and the core count.

    Shuffle partitions: enough for ~``partition_bytes`` each (so a reducer's share fits in
    memory without heavy spill) and at least three waves of tasks; AQE then coalesces
    small ones and splits skewed ones (a partition 5x the median and above 4x the target).
    """
    parts = max(3 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }
