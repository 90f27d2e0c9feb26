"""Session settings and the shared scratch area of the cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings for ``spark-submit``: UTC clocks, adaptive execution, streaming state on disk.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_SHARED_DIR = "spark.checkpoint.dir"
_local_scratch: dict[str, str] = {}


def local_session(cpus: str | int = "*", name: str = "delaylab", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        **RUNTIME_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A local session without the setting gets a fresh temporary folder; on a cluster the
    setting is required, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(_SHARED_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SHARED_DIR} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="delaylab-")
    return _local_scratch[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing), fixes the row
    order of each split, and gives Catalyst true file sizes, so that a join with the
    result is broadcast only if it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
