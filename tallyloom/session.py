"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tallyloom") -> SparkSession:
    """A local session configured like a small cluster: AQE on, UI off, UTC."""
    if shuffle_partitions is None:
        n = (os.cpu_count() or 8) if cpus == "*" else int(cpus)
        shuffle_partitions = max(8, n)
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
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder the cluster names; set one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Where nothing is configured a fresh folder is made on a local master
    only: on a cluster every executor would write to a disk of its own, so that
    is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not fallback and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="tallyloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
