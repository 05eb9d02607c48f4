"""Session settings the engine relies on.

On a cluster the session already exists and owns its settings; ``configure`` only
sets what the engine needs for correct results (UTC session zone, last value of a
repeated JSON key) plus adaptive execution, and leaves sizing to the deployment.
Partition replacement is requested on each write (``sources.sinks``), not
session-wide.  ``local_session`` is for
tests, benches and the driver smoke run.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A JSON object with a repeated key keeps the last value (as a JSON parser in
    # Python does) instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Counts by partition come from file footers (``sources.layers.footer_counts``).
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sintonia") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SINTONIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Small local inputs: let AQE keep several tasks for CPU-heavy stages
        # instead of merging every shuffle below 1 MB into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.  Where none is set, a local session (one
    machine, as in tests) gets a scratch one; a cluster session fails, since its
    executors would write to folders the others cannot see."""
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    master = spark.sparkContext.master or ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sintonia-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local
