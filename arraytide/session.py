"""Session settings and lineage cuts.

The library never assumes a particular cluster. `build` is what the tests and the bench use; on a cluster the
session is handed in and only the settings a plan depends on (UTC, adaptive execution) are expected of it.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build(app: str = "arraytide", cores: str | int = "*", shuffle_partitions: int = 8,
          driver_memory: str = "12g") -> SparkSession:
    """A local session with the settings the operators are written for."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .config("spark.driver.memory", driver_memory)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one the session names, a fresh local one only where it names none."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if named:
        if not current:
            sc.setCheckpointDir(named)
        return named
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    fresh = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(fresh)
    return fresh


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: survives the loss of any executor, unlike a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
