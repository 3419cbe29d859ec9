"""Session helpers: where shared intermediate data goes, and recommended settings.

Library code never sets a master.  Intermediate tables and checkpoints go under the shared
folder the cluster names in ``spark.checkpoint.dir``; only a local-mode session without
that setting (tests, a laptop) gets a private folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine is designed for; callers building their own session pass these.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static estimates: they come from compressed file sizes and say
    # nothing about exploded or aggregated data.  AQE broadcasts a join side only after
    # its stage ran and its measured size is below the threshold; explicit broadcast()
    # hints remain for sides bounded by construction (one row, k rows).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # ranking checkpoints go once their DataFrames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only for local sessions."""
    try:
        sc = spark.sparkContext
    except Exception:  # a client without a SparkContext (Spark Connect): the server's setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lodestar") -> SparkSession:
    """Session for tests and the bench (local mode only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
