"""Registered streaming queries.

Each writes messages derived from the given tables into a folder, runs a stream over all of
them until none are left, and reads back what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.functions import messages
from delaylab.operators import features, joins, learning
from delaylab.plans import jobs
from delaylab.plans.batch_queries import DAY, REQUEST, RESULT
from delaylab.plans.registry import (
    distances_path, model_path, prepared_requests, query, scorer, stored_distances,
)
from delaylab.session import new_dir
from delaylab.sources import readers, testbed, upserts, writers
from delaylab.streaming import matching, progress, sinks, topics


def _publish_requests(spark: SparkSession, sf_dir: str, path: str) -> None:
    topics.request_log(prepared_requests(spark, sf_dir)).write.mode("append").parquet(path)


def _request_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    _publish_requests(spark, sf_dir, f"{path}/topic")
    return topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))


def _naive_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    return learning.naive_score(_request_stream(spark, sf_dir, path))


@query("stream_parse_requests", f"SELECT {REQUEST} FROM prepared", ["prepared"])
def stream_parse_requests(spark, sf_dir):
    path = new_dir(spark, "parse")
    parsed = _request_stream(spark, sf_dir, path)
    sinks.append_stream(parsed, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.REQUEST).parquet(f"{path}/out")


@query("stream_append", f"SELECT {RESULT} FROM scored", ["scored"])
def stream_append(spark, sf_dir):
    """Scored in two runs over one checkpoint; the second must not repeat the first."""
    path = new_dir(spark, "append")
    scored = _naive_stream(spark, sf_dir, path)
    for _ in range(2):
        sinks.append_stream(scored, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.RESULT).parquet(f"{path}/out")


@query(
    "stream_upsert_results",
    """SELECT uuid, origin, dest, carrier, flight_date, dep_delay + 1 AS dep_delay, distance,
  CASE WHEN dep_delay + 1 < -15 THEN 0 WHEN dep_delay + 1 < 0 THEN 1 WHEN dep_delay + 1 < 30 THEN 2
    ELSE 3 END AS prediction, "timestamp" FROM responses""",
    ["responses"],
)
def stream_upsert_results(spark, sf_dir):
    """Every request is sent, then sent again with a changed delay; the later one counts."""
    path = new_dir(spark, "upsert")
    requests = prepared_requests(spark, sf_dir)
    for shift in (0.0, 1.0):
        changed = requests.withColumn("DepDelay", F.col("DepDelay") + shift)
        topics.request_log(changed).write.mode("append").parquet(f"{path}/topic")
        parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))
        scored = learning.naive_score(parsed)
        sinks.upsert_stream(scored, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return upserts.read_latest(spark, f"{path}/table")


@query(
    "stream_response_json",
    """SELECT UUID AS "key", UUID, Origin, Dest, Carrier, FlightDate, DepDelay, Distance,
  Prediction AS prediction, Timestamp FROM scored""",
    ["scored"],
)
def stream_response_json(spark, sf_dir):
    path = new_dir(spark, "responses")
    scored = _naive_stream(spark, sf_dir, path)
    sinks.publish_stream(scored, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    sent = spark.read.schema("key STRING, value STRING").parquet(f"{path}/out")
    return sent.select("key", messages.parse_response(F.col("value")).alias("r")).select(
        "key", "r.*"
    )


@query("stream_score", f"SELECT {REQUEST}, 1 AS as_in_batch FROM prepared", ["prepared"])
def stream_score(spark, sf_dir):
    """Every request scored by the stored model as it streams, set against the batch score."""
    path = new_dir(spark, "stream-score")
    model = scorer(spark, sf_dir)
    scored = learning.score(_request_stream(spark, sf_dir, path), model)
    sinks.append_stream(scored, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    streamed = spark.read.schema(schemas.RESULT).parquet(f"{path}/out")
    batch = learning.score(prepared_requests(spark, sf_dir), model).select(
        "UUID", F.col("Prediction").alias("expected")
    )
    same = F.col("Prediction") == F.col("expected")
    return streamed.join(batch, "UUID").select(*schemas.REQUEST.names, same.alias("as_in_batch"))


def _fan_out_targets(path: str) -> dict[str, sinks.BatchSink]:
    return {
        "documents": sinks.documents(f"{path}/documents"),
        "table": sinks.response_table(f"{path}/table"),
        "topic": sinks.response_topic(f"{path}/responses"),
    }


_HELD = ["uuid", "origin", "dest", "carrier", "flight_date", "dep_delay", "distance"]


def _sink_rows(spark: SparkSession, path: str) -> DataFrame:
    """What each sink holds of every request; predictions come from a fitted model and are left out."""
    sent = spark.read.parquet(f"{path}/responses").select(
        messages.parse_response(F.col("value")).alias("r")
    ).select("r.*")
    held = {
        "documents": features.response_projection(spark.read.parquet(f"{path}/documents")),
        "table": upserts.read_latest(spark, f"{path}/table"),
        "topic": features.response_projection(sent.withColumnRenamed("prediction", "Prediction")),
    }
    parts = [df.select(F.lit(name).alias("sink"), *_HELD) for name, df in held.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_SINK_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS sink, {', '.join(_HELD)} FROM responses"
    for name in ("documents", "table", "topic")
)


@query("stream_fanout", _SINK_SQL, ["responses"])
def stream_fanout(spark, sf_dir):
    """Two queries with checkpoints of their own share the sinks; the table is compacted after them."""
    path = new_dir(spark, "fanout")
    model = scorer(spark, sf_dir)
    requests = prepared_requests(spark, sf_dir)
    targets = _fan_out_targets(path) | {"table": sinks.response_table(f"{path}/versions")}
    for part in range(2):
        mine = requests.where(F.pmod(F.xxhash64("UUID"), F.lit(2)) == part)
        topics.request_log(mine).write.parquet(f"{path}/topic-{part}")
        parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic-{part}"))
        scored = learning.score(parsed, model)
        sinks.fan_out(scored, targets, f"{path}/checkpoint-{part}").awaitTermination()
    upserts.compact(spark, f"{path}/versions", f"{path}/table")
    return _sink_rows(spark, path)


@query("stream_dedup_requests", f"SELECT {REQUEST} FROM prepared", ["prepared"])
def stream_dedup_requests(spark, sf_dir):
    """The later half is delivered first; then all messages come, older and repeated ones alike."""
    path = new_dir(spark, "dedup")
    requests = prepared_requests(spark, sf_dir)
    targets = {
        "documents": sinks.documents(f"{path}/documents"), "seen": sinks.remembered(f"{path}/seen"),
    }
    for part in (requests.where(F.col("Timestamp") >= F.lit(DAY).cast("timestamp_ntz")), requests):
        for _ in range(2):
            topics.request_log(part).write.mode("append").parquet(f"{path}/topic")
        parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))
        sinks.fan_out(
            parsed, targets, f"{path}/checkpoint", prepare=sinks.first_seen(f"{path}/seen")
        ).awaitTermination()
    return spark.read.parquet(f"{path}/documents").select(*schemas.REQUEST.names)


@query(
    "stream_response_join",
    """SELECT r.UUID AS id, r.Timestamp AS asked_at,
  CASE WHEN r.responded THEN 'OK' ELSE 'WAIT' END AS status,
  CASE WHEN r.responded THEN CAST(s.prediction AS VARCHAR) END AS prediction
FROM requests r JOIN responses s ON r.UUID = s.uuid""",
    ["responses"],
)
def stream_response_join(spark, sf_dir):
    """Requests matched to responses that come some minutes later, three times over, or not at all."""
    path = new_dir(spark, "match")
    scored = learning.naive_score(prepared_requests(spark, sf_dir))
    topics.request_log(scored).write.parquet(f"{path}/requests")
    answered = scored.join(testbed.responded(spark, sf_dir), "UUID", "semi").withColumn(
        "answered_at", F.col("Timestamp") + F.expr("INTERVAL 5 MINUTES")
    )
    log = topics.as_log(
        answered.withColumn("message", messages.response_message()),
        schemas.RESPONSE_TOPIC, "answered_at",
    )
    for _ in range(3):
        log.write.mode("append").parquet(f"{path}/responses")

    def asked(topic):
        return topic.select(topics.key_text().alias("UUID"), F.col("timestamp").alias("asked_at"))

    def replies(topic):
        return topic.select(
            topics.key_text().alias("uuid"), F.col("timestamp").alias("answered_at"), "offset",
            messages.parse_response(F.col("value"))["prediction"].cast("int").alias("prediction"),
        )

    matched = matching.match_responses(
        asked(readers.stream_topic(spark, f"{path}/requests")),
        replies(readers.stream_topic(spark, f"{path}/responses")), spread=F.col("offset"),
    )
    sinks.append_stream(matched, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    told = spark.read.schema(matched.schema).parquet(f"{path}/out")
    late = matching.close_out(
        asked(readers.read_topic(spark, f"{path}/requests")),
        replies(readers.read_topic(spark, f"{path}/responses")), told,
    )
    return told.unionByName(late).select(
        "id", F.col("asked_at").cast("timestamp_ntz").alias("asked_at"), "status",
        F.col("prediction").cast("string").alias("prediction"),
    )


@query(
    "topic_lag",
    f"""SELECT 'requests' AS topic, CAST(user_id % 4 AS INT) AS "partition", count(*) AS messages,
  count(*) FILTER (WHERE ts < TIMESTAMP '{DAY}') AS consumed,
  count(*) FILTER (WHERE ts >= TIMESTAMP '{DAY}') AS lag FROM events GROUP BY 2""",
)
def topic_lag(spark, sf_dir):
    """A query reads the first half of a topic; what it has left when the second half has come."""
    path = new_dir(spark, "lag")
    log = testbed.message_log(spark, sf_dir)
    half = F.col("timestamp") < F.lit(DAY).cast("timestamp_ntz")
    log.where(half).write.parquet(f"{path}/topic")
    stream = readers.stream_topic(spark, f"{path}/topic").select("topic", "partition", "offset")
    sinks.append_stream(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    log.where(~half).write.mode("append").parquet(f"{path}/topic")
    return progress.file_lag(spark, readers.read_topic(spark, f"{path}/topic"), f"{path}/checkpoint")


@query(
    "response_lookup",
    """SELECT r.UUID AS id, CASE WHEN r.responded THEN 'OK' ELSE 'WAIT' END AS status,
  CASE WHEN r.responded THEN s.dep_delay + 1 END AS dep_delay
FROM requests r JOIN responses s ON r.UUID = s.uuid WHERE r.UUID IN (
  SELECT min(UUID) FROM requests GROUP BY responded)""",
    ["responses"],
)
def response_lookup(spark, sf_dir):
    """One answered and one unanswered request, each looked up by its id in the response table.

    Every response is stored twice, in two batches; the later one counts.
    """
    path = new_dir(spark, "lookup")
    scored = learning.naive_score(prepared_requests(spark, sf_dir)).join(
        testbed.responded(spark, sf_dir), "UUID", "semi"
    )
    for batch in range(2):
        changed = scored.withColumn("DepDelay", F.col("DepDelay") + batch)
        sinks.response_table(f"{path}/table")(changed, batch)
    answered = testbed.responded(spark, sf_dir)
    requests = testbed.requests(spark, sf_dir).select("UUID")
    first = F.min("UUID").alias("UUID")
    asked = requests.join(answered, "UUID", "semi").agg(first).unionByName(
        requests.join(answered, "UUID", "left_anti").agg(first)
    )
    found = None
    for row in asked.collect():
        one = upserts.look_up(spark, f"{path}/table", row["UUID"])
        status = joins.response_status(spark.createDataFrame([row]), one).select("id", "status")
        status = status.join(one.select(F.col("uuid").alias("id"), "dep_delay"), "id", "left")
        found = status if found is None else found.unionByName(status)
    return found


_REBUILT_SQL = _SINK_SQL.replace(
    " distance FROM", f""" CASE WHEN distance > 0 AND "timestamp" < TIMESTAMP '{DAY}' THEN distance + 1000
  ELSE distance END AS distance FROM"""
)


@query("job_stream_score", _REBUILT_SQL, ["responses"])
def job_stream_score(spark, sf_dir):
    """The streaming job over the request topic; distances are rebuilt while it runs.

    The first half comes with old distances in store, and every message twice. The table is then
    replaced, without restarting the query, and the whole topic comes once more: what had not
    been seen is scored with the new distances.
    """
    path, model = new_dir(spark, "job-stream"), model_path(spark, sf_dir)
    bare = features.with_date_parts(testbed.requests(spark, sf_dir)).withColumn(
        "Distance", F.lit(None).cast("double")
    )
    distances = stored_distances(spark, sf_dir)
    old = distances.withColumn("Distance", F.col("Distance") + 1000)
    writers.write_distances(old, f"{path}/distances")
    half = F.col("Timestamp") < F.lit(DAY).cast("timestamp_ntz")
    for _ in range(2):
        topics.request_log(bare.where(half)).write.mode("append").parquet(f"{path}/topic")
    running = jobs.stream_score(
        readers.stream_topic(spark, f"{path}/topic"), model,
        f"{path}/distances", _fan_out_targets(path), f"{path}/checkpoint", every="0 seconds",
        seen_path=f"{path}/seen",
    )
    try:
        running.processAllAvailable()
        writers.write_distances(distances, f"{path}/distances")
        topics.request_log(bare).write.mode("append").parquet(f"{path}/topic")
        running.processAllAvailable()
    finally:
        running.stop()
    return _sink_rows(spark, path)
