"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusloom",
                  driver_memory: str = "16g") -> SparkSession:
    """Local session used by tests and the bench (a cluster passes its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None under Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is read from
    the session.  Only when it is unset (local tests) a private folder is made
    and registered, so lineage cuts and scratch tables still have a home.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", str(master)):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and scratch tables "
                               "must survive executor loss")
        root = tempfile.mkdtemp(prefix="corpusloom-ckpt-")  # kept by the context, which the next call asks
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
