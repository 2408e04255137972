"""Session settings and the shared work folder.

Settings the job relies on at scale (AQE with partition coalescing and skew splitting,
broadcasts from measured sizes only, UTC session time, static partition overwrite) are collected here; a cluster sets the sizes
(shuffle partitions, advisory partition size, max partition bytes) for its data volume.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Broadcast only measured sizes: never from the planner's static file-size estimate (a
    # compressed file understates memory), but from AQE's runtime shuffle statistics and from
    # the explicit, measured dimension check in operators/enrich.py.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tilepulse", **extra: str) -> SparkSession:
    """A local session for tests and the bench (UI off, no server)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**JOB_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: the cluster's checkpoint directory.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir); only
    when neither is set in a local session (tests) a fresh local folder is created and
    registered. A cluster without it is refused: a folder on the driver's disk is not seen by
    the executors, nor by the next process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext on this client (e.g. Spark Connect): conf only
            root = None
    if not root:
        if not str(spark.conf.get("spark.master", "")).startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tilepulse-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the work folder (never reused, never cleared)."""
    root = work_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    path = os.path.join(root, "tilepulse", f"{label}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
