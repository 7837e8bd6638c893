"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on or profits from. All are plain Spark settings; a cluster may override them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The state and page lookups are left joins with a unique right side, so a hot left key can be split freely.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Pages are wide: bound Arrow batches by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app: str = "advertlode", **extra: str) -> SparkSession.Builder:
    """A session builder with the library's settings; `extra` wins."""
    b = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        b = b.config(key, value)
    return b


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name for staged tables, under the shared folder in `spark.checkpoint.dir`.

    Without that setting only a session in one process gets a folder of its own; on a cluster, a local one included, a
    machine-local folder would be lost with the machine, so the setting is required there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.mkdtemp(prefix="advertlode-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged tables that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
