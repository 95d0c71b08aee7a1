"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cpus: int | str = "*", app: str = "goalpost", **extra: str) -> SparkSession:
    """Session for tests and the local bench; cluster jobs bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder for tables the jobs write (layers, stream sinks, checkpoints).

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``; a cluster session without one is an
    error, since executors would not see a folder of the driver's machine.  Only a local session (tests) gets a fresh
    temp folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A not-yet-existing path under the shared folder for one job's output."""
    return f"{shared_dir(spark)}/goalpost/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(largest_shuffle_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to pass to a cluster session (not applied by the library).

    Shuffle partitions are sized so the largest shuffle lands at about
    ``target_partition_bytes`` per reducer (AQE then coalesces small stages
    and splits skewed partitions), and never below two waves of tasks.
    """
    slots = max(1, executor_cores * executors)
    parts = max(2 * slots, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
