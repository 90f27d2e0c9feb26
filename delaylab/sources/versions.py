"""Tables and models that are replaced while others read them.

Every replacement is a folder of its own. A pointer names the current one: a line that is
appended once the folder is complete. Readers resolve the pointer once and keep reading the folder
they got, so a rebuild neither fails nor mixes versions; the next reader gets the new one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "published long, version string"


def _pointer(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pointer")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(_POINTER).json(f"{path}/pointer")


def history(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions, the current one first."""
    lines = _pointer(spark, path)
    if lines is None:
        return []
    return [r["version"] for r in lines.orderBy(F.desc("published"), F.desc("version")).collect()]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the current version."""
    known = history(spark, path)
    if not known:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return f"{path}/{known[0]}"


def publish(spark: SparkSession, path: str, write: Callable[[str], object], keep: int = 5) -> str:
    """Write a new version with ``write(folder)`` and make it the current one; returns its folder.

    The ``keep`` newest versions stay for those who still read them, older ones are removed. If
    ``write`` fails, the current version stays what it was.
    """
    version = f"version-{uuid.uuid4().hex}"
    write(f"{path}/{version}")
    lines = _pointer(spark, path)
    last = 0 if lines is None else lines.agg(F.coalesce(F.max("published"), F.lit(0))).first()[0]
    # Later than any other, also where the clocks of two writers differ.
    now = max(time.time_ns() // 1_000, last + 1)
    line = spark.createDataFrame([(now, version)], _POINTER).coalesce(1)
    line.write.mode("append").json(f"{path}/pointer")
    for old in history(spark, path)[max(keep, 1):]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return f"{path}/{version}"
