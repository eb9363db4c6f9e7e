"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the call site of every Column operation triples the time it takes
    # to build a plan of this size.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app_name: str = "riskloom") -> SparkSession:
    """Session for tests and single-node runs. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its
    own: on a cluster, executors cannot see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="riskloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
