"""How far a query has read: offsets and files from its checkpoint, and what is left of a topic."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the numbered files of a checkpoint folder, with the number."""
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_name").alias("name"))
    return lines.where(F.col("name").rlike("^[0-9]+$")).withColumn("number", F.col("name").cast("long"))


def last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the last micro-batch that was completed."""
    return _numbered(spark, f"{checkpoint}/commits").agg(F.max("number")).first()[0]


def _committed_offsets(spark: SparkSession, checkpoint: str) -> list[dict]:
    """What each source had been read to when the last completed batch was planned."""
    batch = last_commit(spark, checkpoint)
    if batch is None:
        return []
    lines = _numbered(spark, f"{checkpoint}/offsets").where(F.col("number") == batch)
    # A version line, a line of settings, then one line per source; a file is far below one split.
    values = [r["value"] for r in lines.coalesce(1).collect()]
    return [json.loads(v) if v != "-" else {} for v in values[2:]]


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme; both spellings name the same local file."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """Files of a file source that completed batches have read, as column ``path``."""
    offsets = _committed_offsets(spark, checkpoint)
    upto = offsets[source]["logOffset"] if offsets else -1
    if upto < 0:
        return spark.createDataFrame([], "path string")
    lines = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId long")
    read = lines.select(entry.alias("e")).where(F.col("e.batchId") <= upto)
    return read.select(_plain(F.col("e.path")).alias("path")).distinct()


def committed_offsets(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """Next offset of every partition of a Kafka source after the completed batches."""
    offsets = _committed_offsets(spark, checkpoint)
    rows = [
        (topic, int(partition), offset)
        for topic, ends in (offsets[source] if offsets else {}).items()
        for partition, offset in ends.items()
    ]
    return spark.createDataFrame(rows, "topic string, partition int, next_offset long")


def offset_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Offsets between what a topic holds (topic, partition, next_offset) and what has been read.

    A partition that has not been read yet lags by all its offsets.
    """
    read = committed.select("topic", "partition", F.col("next_offset").alias("_read"))
    lag = F.col("next_offset") - F.coalesce("_read", F.lit(0))
    return ends.join(read, ["topic", "partition"], "left").withColumn("lag", lag).drop("_read")


def file_lag(spark: SparkSession, log: DataFrame, checkpoint: str) -> DataFrame:
    """Messages, read messages and lag of every partition of a topic kept as files.

    ``log`` is the topic read as files. Offsets of such a log need not be consecutive, so the lag
    counts messages: those of files that no completed batch has read.
    """
    read = committed_files(spark, checkpoint).withColumn("_read", F.lit(True))
    marked = log.select("topic", "partition", _plain(F.col("_metadata.file_path")).alias("path")).groupBy(
        "topic", "partition", "path"
    ).agg(F.count(F.lit(1)).alias("n"))
    n = F.sum(F.when(F.col("_read"), F.col("n")).otherwise(0))
    return marked.join(read, "path", "left").groupBy("topic", "partition").agg(
        F.sum("n").alias("messages"), n.alias("consumed"), (F.sum("n") - n).alias("lag"),
    )
