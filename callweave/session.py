"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def get_session(app: str = "callweave", cores: str | None = None, **extra: str) -> SparkSession:
    """Session with the engine's settings. ``cores`` selects local mode; leave it out on a cluster."""
    builder = SparkSession.builder.appName(app)
    if cores is not None:
        # shuffle partitions stay at Spark's default on a cluster, where AQE coalesces them
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("CALLWEAVE_DRIVER_MEMORY", "8g"))
            .config("spark.sql.shuffle.partitions", "8")
        )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a session whose tasks all run in this process (``local[n]``, as in tests) may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="callweave-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Write ``df`` once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
