"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cinerank") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CINERANK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a fresh scratch folder;
    a cluster without it is a configuration error, because a machine-local
    folder does not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running iterative jobs")
    scratch = tempfile.mkdtemp(prefix="cinerank-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def drop_unused_checkpoints(spark: SparkSession) -> None:
    """Let Spark delete the files of checkpoints that nothing refers to any more.

    Works with ``spark.cleaner.referenceTracking.cleanCheckpoints`` (set it on a
    cluster too): the cleaner acts when the driver collects its garbage, which
    an iterative job with small driver state would rarely do by itself.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
