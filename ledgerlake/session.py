"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Shuffle joins hash the lookup instead of sorting the facts where all its partitions are
    # known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # A task that writes few partition values keeps one open file for each instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "Asia/Singapore",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the settings the jobs expect; `overrides` use `__` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    chosen = {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in {**SETTINGS, **chosen}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in `spark.checkpoint.dir`.

    A single-process session without that setting gets a folder of its own; on a cluster the
    setting is required, because a folder of one machine is lost with that machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="ledgerlake-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
