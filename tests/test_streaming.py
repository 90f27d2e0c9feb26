"""Streams give what batches give, across restarts and repeated messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.operators import learning
from delaylab.plans import jobs, registry
from delaylab.session import new_dir
from delaylab.sources import readers, upserts, writers
from delaylab.streaming import matching, sinks, topics


@pytest.fixture(scope="module")
def requests(spark, sf_dir):
    return registry.prepared_requests(spark, sf_dir)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return registry.scorer(spark, sf_dir)


def publish(df, path):
    topics.request_log(df).write.mode("append").parquet(path)


def stream(spark, path):
    return topics.parse_requests(readers.stream_topic(spark, path))


def test_a_topic_has_rows_in_many_files_when_its_requests_come_from_one_task(spark):
    path = new_dir(spark, "t")
    one_task = spark.range(0, 60_000, 1, 1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("UUID"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.REQUEST.fields if f.name != "UUID"],
    )
    publish(one_task, f"{path}/topic")
    log = spark.read.parquet(f"{path}/topic")
    files = [r["n"] for r in log.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(files) > 1 and max(files) < 2 * min(files)
    assert sum(files) == log.select("offset").distinct().count() == log.select("key").distinct().count() == 60_000


def test_stream_and_batch_predict_the_same(spark, requests, model):
    path = new_dir(spark, "t")
    publish(requests, f"{path}/topic")
    scored = learning.score(stream(spark, f"{path}/topic"), model)
    sinks.append_stream(scored, f"{path}/out", f"{path}/cp").awaitTermination()
    streamed = spark.read.schema(schemas.RESULT).parquet(f"{path}/out")
    pick = ["UUID", "Prediction"]
    batch = learning.score(requests, model).select(*pick)
    assert sorted(map(tuple, streamed.select(*pick).collect())) == sorted(
        map(tuple, batch.collect())
    )


def test_restart_reads_only_what_is_new(spark, requests):
    path = new_dir(spark, "t")
    early = requests.where("Timestamp < '2024-01-15'")
    late = requests.where("Timestamp >= '2024-01-15'")
    for part in (early, late):
        publish(part, f"{path}/topic")
        for _ in range(2):
            sinks.append_stream(
                stream(spark, f"{path}/topic"), f"{path}/out", f"{path}/cp"
            ).awaitTermination()
    held = spark.read.schema(schemas.REQUEST).parquet(f"{path}/out")
    assert held.count() == requests.count() == held.select("UUID").distinct().count()


def test_malformed_messages_reach_no_keyed_sink(spark, requests):
    path = new_dir(spark, "t")
    some = requests.limit(5)
    publish(some, f"{path}/topic")
    bad = spark.createDataFrame([("k", "not json", dt.datetime(2024, 1, 1))],
                                "UUID string, message string, Timestamp timestamp_ntz")
    topics.as_log(bad, "t").write.mode("append").parquet(f"{path}/topic")
    scored = learning.naive_score(stream(spark, f"{path}/topic"))
    targets = {
        "documents": sinks.documents(f"{path}/documents"),
        "table": sinks.response_table(f"{path}/table"),
        "topic": sinks.response_topic(f"{path}/responses"),
    }
    sinks.fan_out(scored, targets, f"{path}/cp").awaitTermination()
    assert spark.read.parquet(f"{path}/documents").count() == 6
    assert upserts.read_latest(spark, f"{path}/table").count() == 5
    assert spark.read.parquet(f"{path}/responses").count() == 5


def test_replayed_batch_changes_nothing(spark, requests, model):
    path = new_dir(spark, "t")
    scored = learning.score(requests, model).select(*schemas.RESULT.names)
    targets = [
        sinks.documents(f"{path}/documents"), sinks.response_table(f"{path}/table"),
        sinks.response_topic(f"{path}/responses"),
    ]
    for _ in range(2):
        for sink in targets:
            sink(scored, 0)
    count = requests.count()
    assert spark.read.parquet(f"{path}/documents").count() == count
    assert upserts.read_latest(spark, f"{path}/table").count() == count
    assert spark.read.parquet(f"{path}/responses").count() == count


def test_later_batch_wins_and_compaction_keeps_it(spark):
    path = new_dir(spark, "t")

    def rows(prediction, *uuids):
        return spark.createDataFrame(
            [(u, "A", "B", "AA", "2024-01-01", 1.0, 2.0, prediction, dt.datetime(2024, 1, 1))
             for u in uuids], schemas.RESPONSE,
        )

    upserts.write_batch(rows(0, "a", "b"), f"{path}/t", 0, "uuid", ["timestamp"])
    upserts.write_batch(rows(3, "b", "c", "c"), f"{path}/t", 1, "uuid", ["timestamp"])
    expected = {("a", 0), ("b", 3), ("c", 3)}

    def held(where):
        latest = upserts.read_latest(spark, where).select("uuid", "prediction").collect()
        assert len(latest) == 3
        return set(map(tuple, latest))

    assert held(f"{path}/t") == expected
    upserts.compact(spark, f"{path}/t", f"{path}/new")
    assert held(f"{path}/new") == expected


def test_queries_share_sinks_and_a_compacted_table(spark, requests):
    """Two queries, a new checkpoint and a compaction lose no rows; the later query wins."""
    path = new_dir(spark, "t")
    early = requests.where("Timestamp < '2024-01-15'")
    late = requests.where("Timestamp >= '2024-01-15'")

    def run(name, df, table):
        publish(df, f"{path}/topic-{name}")
        targets = {
            "documents": sinks.documents(f"{path}/documents"),
            "table": sinks.response_table(f"{path}/{table}"),
            "topic": sinks.response_topic(f"{path}/responses"),
        }
        scored = learning.naive_score(stream(spark, f"{path}/topic-{name}"))
        for _ in range(2):
            sinks.fan_out(scored, targets, f"{path}/cp-{name}").awaitTermination()

    def held(table):
        rows = upserts.read_latest(spark, f"{path}/{table}").collect()
        delays = {r["uuid"]: r["dep_delay"] for r in rows}
        assert len(delays) == len(rows)
        return delays

    run("a", early, "table")
    run("b", late, "table")
    known = {r["UUID"]: r["DepDelay"] for r in requests.collect()}
    assert held("table") == known
    for sink, key in (("documents", "UUID"), ("responses", "key")):
        ids = [r[0] for r in spark.read.parquet(f"{path}/{sink}").select(key).collect()]
        assert sorted(ids) == sorted(known)

    upserts.compact(spark, f"{path}/table", f"{path}/compacted")
    assert held("compacted") == known
    changed = requests.limit(3).withColumn("DepDelay", F.col("DepDelay") + 5)
    run("c", changed, "compacted")
    known |= {r["UUID"]: r["DepDelay"] for r in changed.collect()}
    assert held("compacted") == known
    # A table compacted again is older than what comes later, too.
    upserts.compact(spark, f"{path}/compacted", f"{path}/again")
    back = requests.limit(3)
    run("d", back, "again")
    known |= {r["UUID"]: r["DepDelay"] for r in back.collect()}
    assert held("again") == known


def test_repeated_messages_are_kept_once(spark, requests):
    path = new_dir(spark, "t")
    once = requests.limit(20)
    publish(once, f"{path}/topic")
    hot = once.limit(1)
    publish(hot.select(*hot.columns, F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("col"),
            f"{path}/topic")
    for spread in (None, F.col("offset")):
        out = f"{path}/out-{spread is None}"
        log = readers.stream_topic(spark, f"{path}/topic").select(
            F.col("key").alias("UUID"), "timestamp", "offset"
        )
        single = matching.drop_duplicates(log, "UUID", "timestamp", spread=spread)
        sinks.append_stream(single, out, f"{out}-cp").awaitTermination()
        ids = [r["UUID"] for r in spark.read.parquet(out).collect()]
        assert len(ids) == len(set(ids)) == 20


def test_job_drops_repeated_messages(spark, requests, sf_dir):
    path = new_dir(spark, "t")
    for _ in range(3):
        publish(requests, f"{path}/topic")
    jobs.stream_score(
        readers.stream_topic(spark, f"{path}/topic"), registry.model_path(spark, sf_dir),
        registry.distances_path(spark, sf_dir),
        {"documents": sinks.documents(f"{path}/documents")}, f"{path}/cp",
        duplicates_within="10 minutes",
    ).awaitTermination()
    held = spark.read.parquet(f"{path}/documents")
    assert held.count() == requests.count() == held.select("UUID").distinct().count()


def test_interval_trigger_runs_and_stops(spark, requests):
    path = new_dir(spark, "t")
    publish(requests.limit(3), f"{path}/topic")
    running = sinks.append_stream(
        stream(spark, f"{path}/topic"), f"{path}/out", f"{path}/cp", every="1 second"
    )
    running.processAllAvailable()
    running.stop()
    assert spark.read.schema(schemas.REQUEST).parquet(f"{path}/out").count() == 3


def test_daily_job_may_be_run_again(spark, requests, sf_dir):
    path = new_dir(spark, "t")
    model_path = registry.model_path(spark, sf_dir)
    for day in ("2024-01-10", "2024-01-11", "2024-01-10"):
        jobs.daily_score(
            spark, requests, day, f"{path}/tasks", model_path, f"{path}/results"
        )
    held = spark.read.parquet(f"{path}/results")
    days = requests.where("Timestamp >= '2024-01-10' and Timestamp < '2024-01-12'")
    assert held.count() == days.count() == held.select("UUID").distinct().count()


def test_overwriting_a_day_leaves_the_others(spark, requests):
    path = new_dir(spark, "t")
    writers.write_daily(requests, path)
    before = spark.read.parquet(path).groupBy("request_date").count().collect()
    day = readers.requests_in_window(requests, "2024-01-10")
    writers.write_daily(day.limit(1), path)
    after = dict(map(tuple, spark.read.parquet(path).groupBy("request_date").count().collect()))
    for row in before:
        expected = 1 if str(row["request_date"]) == "2024-01-10" else row["count"]
        assert after[row["request_date"]] == expected


def test_distance_is_filled_only_where_it_was_not_sent(spark, requests, sf_dir):
    path = new_dir(spark, "t")
    sent = requests.limit(10).withColumn(
        "Distance", F.when(F.col("DepDelay") % 2 == 0, F.lit(7.0))
    )
    publish(sent, f"{path}/topic")
    distances = registry.distances_path(spark, sf_dir)
    jobs.stream_score(
        readers.stream_topic(spark, f"{path}/topic"), registry.model_path(spark, sf_dir),
        distances, {"documents": sinks.documents(f"{path}/documents")}, f"{path}/cp",
    ).awaitTermination()
    held = {r["UUID"]: r["Distance"] for r in spark.read.parquet(f"{path}/documents").collect()}
    known = {r["UUID"]: r["Distance"] for r in requests.limit(10).collect()}
    for row in sent.collect():
        expected = 7.0 if row["Distance"] is not None else known[row["UUID"]]
        assert held[row["UUID"]] == expected
