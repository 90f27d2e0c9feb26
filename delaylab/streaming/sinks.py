"""Streaming sinks: appended files, keyed table, response topic, and all of them at once."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from delaylab.operators.features import response_projection
from delaylab.operators.hotkeys import first_per_key
from delaylab.sources import upserts
from delaylab.streaming.topics import addressed, response_messages


class BatchSink(Protocol):
    """Writes one batch of one run; written again, it replaces what it wrote before."""

    def __call__(self, batch: DataFrame, batch_id: int, run: str = upserts.NO_RUN) -> None: ...


#: Turns a micro-batch into the rows that all sinks get; called with batch, number and run.
Prepare = Callable[[DataFrame, int, str], DataFrame]


def note_start(spark: SparkSession, checkpoint: str) -> None:
    """Write down when the query of ``checkpoint`` first started, unless that has been done.

    The time is a line of a file below the checkpoint and goes wherever the checkpoint is copied.
    """
    now = spark.createDataFrame([(f"{time.time_ns() // 1_000_000:015d}",)], "started string")
    now.coalesce(1).write.mode("ignore").text(f"{checkpoint}/first-start")


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """First start and id of the query that owns ``checkpoint``; names of later queries sort behind.

    Both come from what is written in files there, so a restart, or a copy, keeps them.
    """
    started = spark.read.text(f"{checkpoint}/first-start").agg(F.min("value")).first()[0]
    return f"{started}-{json.loads(spark.read.text(f'{checkpoint}/metadata').first().value)['id']}"


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` is an interval such as "10 seconds"; None processes what is there and ends."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


@contextmanager
def state_partitions(spark: SparkSession, wanted: int | None = None):
    """Number of state partitions for the streams started inside.

    A stream keeps the number it first started with. Without ``wanted`` it is what the session
    is configured with, whatever executors are there at the start.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    if wanted is not None:
        spark.conf.set(setting, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None,
    format: str = "parquet", partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to a file store, exactly once per message across restarts."""
    writer = df.writeStream.format(format).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    with state_partitions(df.sparkSession, partitions):
        return triggered(writer, every).start(path)


def publish_stream(
    scored: DataFrame, location: str, checkpoint: str, every: str | None = None,
    format: str = "parquet", **options: str,
) -> StreamingQuery:
    """Answer scored requests on a topic: a Kafka topic, or a folder of message files."""
    writer = (
        response_messages(addressed(scored)).writeStream.format(format).options(**options)
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    if format == "kafka":
        return triggered(writer.option("topic", location), every).start()
    return triggered(writer, every).start(location)


def documents(path: str) -> BatchSink:
    """Scored requests as they are; a replayed batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int, run: str = upserts.NO_RUN) -> None:
        batch.write.mode("overwrite").parquet(upserts.batch_folder(path, batch_id, run))

    return write


def response_table(path: str) -> BatchSink:
    """Rows of the response table, one per uuid."""

    def write(batch: DataFrame, batch_id: int, run: str = upserts.NO_RUN) -> None:
        rows = response_projection(addressed(batch))
        upserts.write_batch(rows, path, batch_id, "uuid", ["timestamp"], run)

    return write


def response_topic(location: str, format: str = "parquet", **options: str) -> BatchSink:
    """Response messages of the batch."""

    def write(batch: DataFrame, batch_id: int, run: str = upserts.NO_RUN) -> None:
        writer = response_messages(addressed(batch)).write.format(format).options(**options)
        if format == "kafka":
            writer.option("topic", location).save()
        else:
            writer.mode("overwrite").save(upserts.batch_folder(location, batch_id, run))

    return write


def first_seen(path: str, key: str = "UUID") -> Prepare:
    """Rows whose key no earlier batch had, however long ago; one row of each key.

    The keys that have been let through are a table of their own below ``path`` (see
    ``upserts.unseen``); no watermark forgets them, so late rows that are no copies are kept.
    Rows without a key cannot be told apart and are left out.
    """

    def prepare(batch: DataFrame, batch_id: int, run: str) -> DataFrame:
        rest = [c for c in batch.columns if c != key]
        named = batch.where(F.col(key).isNotNull())
        single = first_per_key(named, [key], rest)
        return upserts.unseen(single, path, batch_id, key, run, of=named)

    return prepare


def remembered(path: str, key: str = "UUID") -> BatchSink:
    """Remembers the keys of what :func:`first_seen` let through; belongs among the sinks."""

    def write(batch: DataFrame, batch_id: int, run: str = upserts.NO_RUN) -> None:
        upserts.write_keys(batch, path, batch_id, key, run)

    return write


def fan_out(
    df: DataFrame, sinks: dict[str, BatchSink], checkpoint: str, every: str | None = None,
    prepare: Prepare | None = None,
) -> StreamingQuery:
    """Feed every sink from one query: a batch is read and scored once, then written to each.

    All sinks see the same batches. A batch is replayed after a failure; file sinks replace
    what they had written for it, so they end up with every message once. Several queries may
    share a sink: each writes to folders of its own. ``prepare`` is applied to each batch as an
    ordinary DataFrame, for steps that read stored tables as they are at that moment.
    """
    run: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_name(batch.sparkSession, checkpoint))
        rows = batch if prepare is None else prepare(batch, batch_id, run[0])
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks.values():
                sink(rows, batch_id, run[0])
        finally:
            rows.unpersist()

    note_start(df.sparkSession, checkpoint)
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    with state_partitions(df.sparkSession):
        return triggered(writer, every).start()


def upsert_stream(
    scored: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the response table up to date, one row per uuid; queries may share the table."""
    return fan_out(scored, {"table": response_table(path)}, checkpoint, every)
