"""Spark session settings the builders assume, and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (all time math is zone-free anyway),
# AQE with skew-join splitting and runtime broadcast of small join sides.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Parquet files hold columns in a fraction of their size as rows: without this, tables of over 100 MB
    # count as small and are collected in the driver to be broadcast.  AQE still broadcasts by real sizes.
    "spark.sql.sources.fileCompressionFactor": "16",
    # Shuffle files go when the statement that wrote them ends.  Spark otherwise keeps them until the driver's
    # garbage is collected, which a job of many writes may not see: they add up on the executors' disks.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Most bytes of rows that the driver collects to broadcast one side of a join.
BROADCAST_BYTES = 1 << 20


def limit_broadcasts(spark: SparkSession) -> None:
    """Let no side of a join over ``BROADCAST_BYTES`` through the driver; a lower limit of the session stays.

    A side of 10 MB (Spark's limit) is over 40 MB as a hashed table, beside the rows it was built from and the
    blocks that are sent out, and a plan of several branches holds some six of them at once."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "10m",  # Spark's own
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # if unset, it follows the first
    for name, unset in limits.items():
        now = spark.conf.get(name, unset)
        if now.startswith("-"):
            continue
        if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > BROADCAST_BYTES:
            spark.conf.set(name, str(BROADCAST_BYTES))


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "webtrail") -> SparkSession:
    """A local session for tests and benchmarks; sets a checkpoint folder only if none is set."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    limit_broadcasts(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a local session without one (tests) gets a
    scratch folder, as on a cluster each machine would have another."""
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            master = spark.sparkContext.master
            if not re.fullmatch(r"local(\[.*\])?", master):
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
            d = tempfile.mkdtemp(prefix="webtrail-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (visible to every executor)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
