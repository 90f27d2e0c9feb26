"""Stateful streams: duplicate requests, and requests joined to their responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_duplicates(
    df: DataFrame, key: str, moment: str, delay: str = "10 minutes",
    spread: Column | None = None, salts: int = 64,
) -> DataFrame:
    """One row per ``key`` within the watermark.

    With ``spread``, a column that differs between copies such as the message offset,
    copies are first reduced per key and salt. That spreads the copies of a much repeated
    key over ``salts`` tasks, and the second step sees at most ``salts`` rows of any key.
    The state of both steps is bounded by the watermark. Rows older than the watermark are
    dropped, copies or not: ``delay`` has to cover the longest outage or backfill. Where it
    cannot, ``sinks.first_seen`` tells copies apart at any age.
    """
    marked = df.withWatermark(moment, delay)
    if spread is not None:
        marked = marked.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
        marked = marked.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def _status(matched: Column) -> Column:
    return F.when(matched, "OK").otherwise("WAIT").alias("status")


def match_responses(
    requests: DataFrame, responses: DataFrame, delay: str = "10 minutes", wait: str = "1 hour",
    spread: Column | None = None,
) -> DataFrame:
    """Every request with its response, or ``WAIT`` once none can come any more.

    ``requests`` has UUID and asked_at, ``responses`` has uuid, answered_at and prediction.
    A response counts if it comes within ``wait`` of its request; the time bound lets both
    sides forget rows the watermark has passed. A response delivered again within ``delay``
    of the watermark is taken once, so it does not repeat its request; ``spread`` deals much
    repeated responses out (see :func:`drop_duplicates`).

    An answer goes out at once, a ``WAIT`` when the watermark has passed. It does not pass the
    requests of the last hour until later messages come: :func:`close_out` answers for them.
    """
    asked = requests.withWatermark("asked_at", delay)
    answered = drop_duplicates(responses, "uuid", "answered_at", delay, spread).select(
        F.col("uuid").alias("uuid_"), "answered_at", "prediction"
    )
    bound = F.expr(
        f"UUID = uuid_ AND answered_at >= asked_at AND answered_at <= asked_at + INTERVAL {wait}"
    )
    joined = asked.join(answered, bound, "leftOuter")
    return joined.select(
        F.col("UUID").alias("id"), "asked_at", _status(F.col("uuid_").isNotNull()), "prediction",
    )


def close_out(
    requests: DataFrame, responses: DataFrame, told: DataFrame, wait: str = "1 hour",
    as_of: Column | None = None,
) -> DataFrame:
    """The requests that the stream has not answered for, from the stored topics, as a batch.

    ``told`` has the ids that :func:`match_responses` has given out. The first response within
    ``wait`` counts. Requests without one are ``WAIT``; with ``as_of`` only those whose time is
    up by then, and the others stay open for a later run. Copies of a request, and copies of a
    response, are taken once; the latter are reduced before they travel.
    """
    known = told.select(F.col("id").alias("UUID")).distinct()
    rest = requests.select("UUID", "asked_at").distinct().join(known, "UUID", "left_anti")
    answers = responses.groupBy(F.col("uuid").alias("uuid_"), "answered_at").agg(
        F.min("prediction").alias("prediction")
    )
    bound = F.expr(
        f"UUID = uuid_ AND answered_at >= asked_at AND answered_at <= asked_at + INTERVAL {wait}"
    )
    # Times are compared as numbers, so that the first answer is found by a hash aggregate.
    first = rest.join(answers, bound, "left").groupBy("UUID", "asked_at").agg(
        F.min_by("prediction", F.unix_micros("answered_at")).alias("prediction"),
        F.count("uuid_").alias("_answers"),
    )
    if as_of is not None:
        first = first.where((F.col("_answers") > 0) | (F.col("asked_at") + F.expr(f"INTERVAL {wait}") < as_of))
    return first.select(
        F.col("UUID").alias("id"), "asked_at", _status(F.col("_answers") > 0), "prediction",
    )
