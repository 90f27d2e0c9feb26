"""The queries of this package and their SQL counterparts, by name."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaylab.llm import (
    chat, decontamination, language, licenses, linededup, neardup, packing, quality, runs, search,
    sharding, urls, vectors,
)
from delaylab.llm.scratch import small_batches

MODULES = (
    sharding, decontamination, language, packing, linededup, quality, urls, chat, neardup, licenses, runs,
    search, vectors,
)

Query = Callable[[SparkSession, str], DataFrame]
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let executors import this package where it is not installed or on their path."""
    app = spark.sparkContext.applicationId
    if app in _sent or _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _sent.add(app)
    # The driver serves this file to the executors itself.
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "delaylab.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(_ROOT, "delaylab")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, _ROOT))
    spark.sparkContext.addPyFile(path)


def _sending(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_package(spark)
        small_batches(spark)
        return query(spark, sf_dir.rstrip("/"))

    return run


QUERIES = {name: _sending(q) for module in MODULES for name, q in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
