"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every plan assumes; all of them can be set on a live session.

    Times in telemetry have no zone, so the session zone is pinned to UTC. Adaptive execution
    coalesces small shuffle partitions and splits skewed ones in joins.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-process session without that setting,
    as in tests, gets a temporary folder; on a cluster a machine-local folder would be lost with its host.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    created = tempfile.mkdtemp(prefix="tracewell-")
    spark.conf.set(CHECKPOINT_KEY, created)
    return created


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), name)
