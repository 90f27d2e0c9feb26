"""Request and response topics as streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.functions import messages
from delaylab.operators.features import flatten
from delaylab.streaming.matching import drop_duplicates


def as_log(df: DataFrame, topic: str, moment: str = "Timestamp") -> DataFrame:
    """Keyed messages (columns UUID, message and ``moment``) in the shape of a topic.

    Messages of one key share a partition. Offsets rise within each partition; as in any
    log they need not be consecutive.
    """
    return df.select(
        F.col("UUID").cast("binary").alias("key"),
        F.col("message").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("UUID"), F.lit(4)).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.col(moment).cast("timestamp").alias("timestamp"),
    )


def request_log(requests: DataFrame) -> DataFrame:
    """Enriched requests as messages of the request topic.

    Rows are first dealt evenly over the cores. A scan has no more tasks with rows than its file has
    row groups, and the files of the topic hand that down to whoever reads and scores the messages.
    """
    spread = requests.hint("rebalance")
    return as_log(
        spread.withColumn("message", messages.request_message()), schemas.REQUEST_TOPIC
    )


def parse_requests(log: DataFrame) -> DataFrame:
    """Flat typed requests; a malformed message gives a row of nulls."""
    return flatten(log.select(messages.parse_request(F.col("value")).alias("flight")), "flight")


def parse_once(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Flat typed requests, each identifier once within the watermark.

    Messages without an identifier cannot be told apart and are left out.
    """
    parsed = log.select(
        messages.parse_request(F.col("value")).alias("flight"),
        F.col("timestamp").alias("received_at"), "offset",
    ).select("flight.*", "received_at", "offset")
    single = drop_duplicates(
        addressed(parsed), "UUID", "received_at", delay, spread=F.col("offset")
    )
    return single.drop("received_at", "offset")


def key_text() -> Column:
    """The key of a message as text."""
    return F.col("key").cast("string")


def addressed(df: DataFrame) -> DataFrame:
    """Rows with an identifier; only they can be stored by key or answered."""
    return df.where(F.col("UUID").isNotNull())


def response_messages(scored: DataFrame) -> DataFrame:
    """Key and JSON value of the response to every scored request."""
    return scored.select(F.col("UUID").alias("key"), messages.response_message().alias("value"))


def parse_responses(log: DataFrame) -> DataFrame:
    return flatten(log.select(messages.parse_response(F.col("value")).alias("r")), "r")
