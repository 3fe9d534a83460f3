"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(
    cpus: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf: str
) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("metricloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path for tables and checkpoints that must outlive a task.

    It lies in the shared folder the session names in ``spark.checkpoint.dir``.
    Only a local session may go without that setting.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="metricloom-")
    return f"{base.rstrip('/')}/metricloom/{purpose}-{uuid.uuid4().hex}"
