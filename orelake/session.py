"""Session helpers. Library code takes the session it is given; these are for
tests, the benchmark and local runs, plus the one setting jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything else is left to the cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next step wanted the join's partitioning;
    # the extra shuffle is paid only when a skewed partition is met.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start with many partitions, of which Spark puts small ones together, so that
    # a task's share is bounded by the size below and does not grow with the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A task that reads a split holds what it writes to a shuffle, several times the split.
    "spark.sql.files.maxPartitionBytes": "32m",
}


def adapt(spark: SparkSession) -> None:
    """Turn on the settings of shuffles and file splits the plans count on, in a session
    made elsewhere."""
    for k, v in DEFAULTS.items():
        if k.startswith(("spark.sql.adaptive.", "spark.sql.files.")):
            spark.conf.set(k, v)


def local_session(cpus: int | str = 8, app: str = "orelake") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("ORELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: list[tempfile.TemporaryDirectory] = []  # of local sessions; removed when Python ends


def _local_folder(spark: SparkSession, purpose: str) -> str:
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(
            f"spark.checkpoint.dir is not set, and a folder of this machine is not seen by the executors of {master}"
        )
    _LOCAL.append(tempfile.TemporaryDirectory(prefix=f"orelake-{purpose}-", ignore_cleanup_errors=True))
    return _LOCAL[-1].name


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the cluster names for what all its machines must see."""
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; where none is set, a temporary one
    for a local master and an error for any other."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark) or _local_folder(spark, "ckpt"))
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, under the cluster's shared checkpoint
    folder; the same exception for local masters."""
    shared = shared_folder(spark)
    if shared:
        return f"{shared.rstrip('/')}/orelake-{purpose}-{uuid.uuid4().hex}"
    return _local_folder(spark, purpose)
