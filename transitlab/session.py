"""SparkSession construction and shared-storage locations.

Queries never change the session they are handed; this builder is for tests, the bench and scripts.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here is written for: AQE re-plans joins and coalesces partitions at run time,
# splits skewed sort-merge partitions, and all times are UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Sizing for a large cluster (hundreds of TB, ~1000 executors): start with many shuffle partitions and let
# AQE coalesce them to ~256 MB; scan splits of 256 MB; split skewed join partitions above 5x the median.
# Which joins broadcast is left to the planner and AQE.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "transitlab", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    """The folder ``spark.checkpoint.dir`` names, from the session or from the application's settings."""
    try:
        named = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset
        named = None
    if named:
        return named
    try:
        return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local SparkContext
        return None


def _on_one_machine(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 - a remote session: never assume that folders are shared
        return False
    return master == "local" or master.startswith("local[")


# folder chosen here for a session on one machine that names none (tests): application id -> folder
_OWN_DIRS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` where it is set; otherwise the parent of the folder given to
    ``SparkContext.setCheckpointDir`` (which appends a random sub-folder); otherwise, only when the master is
    one machine (``local``/``local[n]``), a fresh temporary folder. A cluster session that names no shared
    folder is an error: a machine-local folder would lose files with its machine.
    """
    named = _configured_dir(spark)
    if named:
        return named.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - remote session
        current = None
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    if not _on_one_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="transitlab-ckpt-")
    return _OWN_DIRS[app]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder it writes to."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local SparkContext
        return shared_root(spark)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(spark))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared location, for written tables that cut lineage."""
    return "/".join([shared_root(spark), "transitlab", *parts])


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path, whatever storage it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this application wrote and no longer reads, by the file system it lies on."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)
