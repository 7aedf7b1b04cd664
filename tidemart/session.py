"""Session construction and the one shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold at any size.  Nothing here depends on the data volume:
# partition counts come from AQE, which starts wide and coalesces.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # the state of a deduplicating stream outgrows a heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
}


def local_session(cpus: int | str = 8, app: str = "tidemart") -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SCALE_CONF, **LOCAL_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the folder named by ``spark.checkpoint.dir``.

    Every executor must see what is written there, so a machine-local folder is
    used only when the session itself is local and names no folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemart")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
