"""Session helpers: the few SQL settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package expects. AQE re-plans joins and coalesces
# small shuffle partitions at run time; skew-join splitting handles hot keys.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Log text is small in bytes but costly to parse: let AQE keep several
    # small post-shuffle partitions instead of merging them into one task.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
    # duplicate JSON keys keep the last value, as Python's json module does
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # the dashboard CSV is code page 1252, a Java charset outside Spark's short list
    "spark.sql.legacy.javaCharsets": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators depend on."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "masklens") -> SparkSession:
    """A local session for tests and benchmarks (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # Python call-site capture for error messages costs about five py4j
        # round trips per Column function while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (also handed to the SparkContext for ``DataFrame.checkpoint``). Only an
    unconfigured session (tests) gets a fresh local scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="masklens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
