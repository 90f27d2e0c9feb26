"""Tables that cut lineage, and their removal once nothing reads them any more."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from delaylab.session import new_dir

_owned: dict[str, list[str]] = {}
_owner: list[str] = []


def stored(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; see :func:`dropped`."""
    path = new_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    if _owner:
        _owned.setdefault(_owner[-1], []).append(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again._scratch_path = path
    return again


def dropped(*tables: DataFrame) -> None:
    """Remove tables of :func:`stored` whose readers have all been written."""
    for table in tables:
        _delete(table.sparkSession, table._scratch_path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send texts to Python in smaller batches than Spark does by default; a set value stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


@contextmanager
def owned(name: str) -> Iterator[None]:
    """Tables stored inside belong to ``name`` and go when it is released."""
    _owner.append(name)
    try:
        yield
    finally:
        _owner.pop()


def released(spark: SparkSession, name: str) -> None:
    """Remove what belongs to ``name``: for callers that have written every result built on it."""
    for path in _owned.pop(name, []):
        _delete(spark, path)
