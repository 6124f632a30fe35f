"""Session factory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from assaycast.config import Config


def get_spark(cfg: Config | None = None, **conf: str) -> SparkSession:
    """The active session on a cluster, else a local one.

    Plant time is naive local time, so the session zone is pinned to UTC in both cases. Other
    settings (shuffle partitions, memory, checkpoint folder) stay as the cluster has them.
    """
    active = SparkSession.getActiveSession()
    if active is None and cfg is not None and not cfg.is_local:
        active = SparkSession.builder.getOrCreate()
    if active is None:
        builder = (
            SparkSession.builder.appName("assaycast")
            .master("local[*]")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
        )
        for key, value in conf.items():
            builder = builder.config(key, value)
        active = builder.getOrCreate()
    active.conf.set("spark.sql.session.timeZone", "UTC")
    return active


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that cuts lineage.

    It lies in the shared folder named by ``spark.checkpoint.dir``; only when that is unset (tests
    in local mode) a temporary folder is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix=f"{name}-")
    return os.path.join(root, f"{name}-{os.urandom(8).hex()}")
