"""Every request gets its answer: matching with close-out, exact duplicates, lag, rebuilt tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylab.operators import learning
from delaylab.plans import jobs, registry
from delaylab.session import new_dir
from delaylab.sources import readers, writers
from delaylab.streaming import matching, progress, sinks, topics

START = dt.datetime(2024, 1, 1)


def test_ten_thousand_requests_are_answered(spark):
    """Responses come three times over, one of them ten thousand times; none comes for every third."""
    path = new_dir(spark, "t")
    asked = spark.range(10_000).select(
        F.concat(F.lit("q"), F.col("id").cast("string")).alias("UUID"),
        (F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 3)).alias("asked_at"),
    )
    asked.write.parquet(f"{path}/requests")
    number = F.substring("UUID", 2, 9).cast("int")
    answer = asked.where(number % 3 > 0).select(
        F.col("UUID").alias("uuid"), (F.col("asked_at") + F.expr("INTERVAL 5 MINUTES")).alias("answered_at"),
        (number % 4).alias("prediction"),
    )
    many = answer.where("uuid = 'q1'").crossJoin(spark.range(10_000)).drop("id")
    rows = answer.unionByName(answer).unionByName(answer).unionByName(many)
    rows.withColumn("offset", F.monotonically_increasing_id()).write.parquet(f"{path}/responses")

    def stream(name):
        folder = f"{path}/{name}"
        return spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)

    matched = matching.match_responses(stream("requests"), stream("responses"), spread=F.col("offset"))
    sinks.append_stream(matched, f"{path}/out", f"{path}/cp").awaitTermination()
    told = spark.read.schema(matched.schema).parquet(f"{path}/out")
    late = matching.close_out(spark.read.parquet(f"{path}/requests"), spark.read.parquet(f"{path}/responses"), told)
    got = told.unionByName(late).collect()
    assert len(got) == len({r["id"] for r in got}) == 10_000
    for r in got:
        n = int(r["id"][1:])
        assert (r["status"], r["prediction"]) == (("OK", n % 4) if n % 3 else ("WAIT", None))


def test_close_out_leaves_open_what_may_still_be_answered(spark):
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    asked = spark.createDataFrame(
        [("old", at(0)), ("new", at(100)), ("told", at(0)), ("twice", at(0)), ("twice", at(0)), ("late", at(0))],
        "UUID string, asked_at timestamp",
    )
    answers = spark.createDataFrame(
        [("twice", at(5), 2), ("twice", at(4), 1), ("late", at(61), 3), ("early", at(-1), 3)],
        "uuid string, answered_at timestamp, prediction int",
    )
    told = spark.createDataFrame([("told",)], "id string")
    as_of = F.lit(at(130)).cast("timestamp")
    got = {r["id"]: (r["status"], r["prediction"]) for r in matching.close_out(asked, answers, told, as_of=as_of).collect()}
    assert got == {"old": ("WAIT", None), "twice": ("OK", 1), "late": ("WAIT", None)}
    assert matching.close_out(asked, answers, told).count() == 4
    assert matching.close_out(asked, answers.limit(0), told.limit(0)).count() == 5


@pytest.fixture(scope="module")
def requests(spark, sf_dir):
    return registry.prepared_requests(spark, sf_dir)


def publish(df, path):
    topics.request_log(df).write.mode("append").parquet(path)


def test_an_older_second_batch_loses_nothing(spark, requests):
    """Messages far behind the watermark that are no copies are kept, copies are not, at any age."""
    path = new_dir(spark, "t")
    targets = {"documents": sinks.documents(f"{path}/documents"), "seen": sinks.remembered(f"{path}/seen")}
    early = requests.where("Timestamp < '2024-01-15'")
    late = requests.where("Timestamp >= '2024-01-15'")
    for part in (late, early, late.limit(50), early.limit(50)):
        publish(part, f"{path}/topic")
        publish(part, f"{path}/topic")
        parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))
        sinks.fan_out(parsed, targets, f"{path}/cp", prepare=sinks.first_seen(f"{path}/seen")).awaitTermination()
    held = [r["UUID"] for r in spark.read.parquet(f"{path}/documents").select("UUID").collect()]
    assert len(held) == len(set(held)) == requests.count()
    # A query with a checkpoint of its own, which reads everything again, finds nothing new.
    sinks.fan_out(
        topics.parse_requests(readers.stream_topic(spark, f"{path}/topic")),
        {"documents": sinks.documents(f"{path}/again")}, f"{path}/cp2", prepare=sinks.first_seen(f"{path}/seen"),
    ).awaitTermination()
    assert spark.read.parquet(f"{path}/again").isEmpty()


def test_a_running_job_takes_new_distances_and_a_new_model(spark, requests, sf_dir):
    path = new_dir(spark, "t")
    bare = requests.withColumn("Distance", F.lit(None).cast("double"))
    distances = registry.stored_distances(spark, sf_dir)
    table = registry.stored_features(spark, sf_dir)
    constant = table.withColumn("ArrDelay", F.lit(100.0))  # a model that knows one class only
    writers.write_distances(distances.withColumn("Distance", F.lit(1.0)), f"{path}/distances")
    small = learning.ForestSettings(trees=2, depth=2)
    learning.save_model(learning.train(constant, small), f"{path}/model")
    first, second = bare.limit(30), bare.orderBy("UUID").limit(30)
    publish(first, f"{path}/topic")
    query = jobs.stream_score(
        readers.stream_topic(spark, f"{path}/topic"), f"{path}/model", f"{path}/distances",
        {"documents": sinks.documents(f"{path}/documents")}, f"{path}/cp", every="0 seconds",
    )
    try:
        query.processAllAvailable()
        before = spark.read.parquet(f"{path}/documents").collect()
        assert len(before) == 30 and {r["Prediction"] for r in before} == {3.0}
        assert {r["Distance"] for r in before} <= {0.0, 1.0}
        writers.write_distances(distances.withColumn("Distance", F.lit(2.0)), f"{path}/distances")
        early = table.withColumn("ArrDelay", F.lit(-100.0))
        learning.save_model(learning.train(early, small), f"{path}/model")
        publish(second, f"{path}/topic")
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.exception() is None
    rows = spark.read.parquet(f"{path}/documents").collect()
    after = [r for r in rows if r["Prediction"] == 0.0]
    assert len(rows) == 60 and len(after) == 30 and {r["Distance"] for r in after} <= {0.0, 2.0}
    assert 2.0 in {r["Distance"] for r in after}


def test_lag_of_a_query(spark, requests):
    path = new_dir(spark, "t")
    publish(requests.limit(40), f"{path}/topic")
    parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))
    log = lambda: readers.read_topic(spark, f"{path}/topic")
    with pytest.raises(Exception, match="(?i)path"):
        progress.last_commit(spark, f"{path}/cp")
    for expected in (0, 1):
        sinks.append_stream(parsed, f"{path}/out", f"{path}/cp").awaitTermination()
        assert progress.last_commit(spark, f"{path}/cp") == expected
        assert progress.file_lag(spark, log(), f"{path}/cp").agg(F.sum("lag")).first()[0] == 0
        publish(requests.limit(25), f"{path}/topic")
        lag = progress.file_lag(spark, log(), f"{path}/cp").agg(F.sum("lag"), F.sum("consumed")).first()
        assert tuple(lag) == (25, 40 + 25 * expected)


def test_lag_of_offsets(spark, tmp_path):
    cp = tmp_path / "cp"
    for name, text in (("commits/0", "v1\n{}"), ("commits/1", "v1\n{}"),
                       ("offsets/0", 'v1\n{}\n{"t":{"0":3}}'), ("offsets/1", 'v1\n{}\n{"t":{"0":7,"1":2}}'),
                       ("offsets/2", 'v1\n{}\n{"t":{"0":9,"1":9}}')):
        (cp / name).parent.mkdir(parents=True, exist_ok=True)
        (cp / name).write_text(text)
    read = progress.committed_offsets(spark, str(cp))
    ends = spark.createDataFrame([("t", 0, 9), ("t", 1, 9), ("t", 2, 4)], "topic string, partition int, next_offset long")
    got = {r["partition"]: r["lag"] for r in progress.offset_lag(ends, read).collect()}
    assert got == {0: 2, 1: 7, 2: 4}


def test_a_copied_checkpoint_keeps_its_run(spark, requests):
    path = new_dir(spark, "t")
    publish(requests.limit(3), f"{path}/topic")
    parsed = topics.parse_requests(readers.stream_topic(spark, f"{path}/topic"))
    target = {"documents": sinks.documents(f"{path}/documents")}
    sinks.fan_out(parsed, target, f"{path}/cp").awaitTermination()
    name = sinks.run_name(spark, f"{path}/cp")
    spark.read.text(f"{path}/cp/first-start").write.text(f"{path}/copy/first-start")
    spark.read.text(f"{path}/cp/metadata").coalesce(1).write.text(f"{path}/copy/metadata")
    assert sinks.run_name(spark, f"{path}/copy") == name
    sinks.fan_out(parsed, target, f"{path}/cp").awaitTermination()
    assert sinks.run_name(spark, f"{path}/cp") == name
