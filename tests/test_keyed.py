"""The keyed table: lookups by key, order of versions, keys seen before; and versioned tables."""

import datetime as dt
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.session import new_dir
from delaylab.sources import upserts, versions
from delaylab.streaming import sinks
from tests.test_plans import plan


def rows(spark, prediction, uuids, day=1):
    return spark.createDataFrame(
        [(u, "A", "B", "AA", "2024-01-01", 1.0, 2.0, prediction, dt.datetime(2024, 1, day)) for u in uuids],
        schemas.RESPONSE,
    )


@pytest.fixture(scope="module")
def table(spark):
    path = new_dir(spark, "keyed")
    many = [f"u{i}" for i in range(3000)]
    for batch in range(3):
        upserts.write_batch(rows(spark, batch, many), path, batch, "uuid", ["timestamp"])
    return path


def test_a_lookup_reads_one_folder(spark, table):
    found = upserts.look_up(spark, table, "u77")
    text = plan(found)
    bucket = spark.range(1).select(upserts.bucket_of(F.lit("u77"))).first()[0]
    assert f"(bucket#" in text and re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}\)", text)
    assert "EqualTo(uuid,u77)" in text
    # The filter stands below the step that picks the last version.
    assert text.index("Window") < text.index("PushedFilters")
    assert [(r["uuid"], r["prediction"]) for r in found.collect()] == [("u77", 2)]
    assert upserts.look_up(spark, table, "nobody").collect() == []


def test_files_have_bloom_filters_of_modest_size(spark, table):
    file = upserts.look_up(spark, table, "u77").inputFiles()[0].removeprefix("file://")
    meta = duckdb.sql(f"SELECT path_in_schema, bloom_filter_offset FROM parquet_metadata('{file}')").fetchall()
    assert {name: at is not None for name, at in meta}["uuid"]
    assert os.path.getsize(file) < 100_000


def test_many_lookups_at_once(spark, table):
    wanted = spark.createDataFrame([("u1",), ("u2",), ("u2",), ("nobody",)], "uuid string")
    got = upserts.look_up_many(spark, table, wanted).select("uuid", "prediction").collect()
    assert sorted(map(tuple, got)) == [("u1", 2), ("u2", 2)]


def test_the_later_answer_wins_whoever_wrote_it(spark):
    path = new_dir(spark, "keyed")
    upserts.write_batch(rows(spark, 1, ["a"], day=9), path, 5, "uuid", ["timestamp"], "001-early")
    upserts.write_batch(rows(spark, 2, ["a", "b"], day=3), path, 7, "uuid", ["timestamp"], "002-late")
    held = {r["uuid"]: r["prediction"] for r in upserts.read_latest(spark, path).collect()}
    assert held == {"a": 1, "b": 2}
    assert upserts.look_up(spark, path, "a").first()["prediction"] == 1
    # Of equal times the later batch of the later run counts.
    upserts.write_batch(rows(spark, 3, ["a"], day=9), path, 0, "uuid", ["timestamp"], "002-late")
    assert upserts.look_up(spark, path, "a").first()["prediction"] == 3
    upserts.compact(spark, path, f"{path}-new")
    assert upserts.look_up(spark, f"{path}-new", "a").first()["prediction"] == 3


def test_keys_are_remembered_and_replays_are_not(spark):
    path = new_dir(spark, "seen")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, n int")
    assert upserts.unseen(df, path, 0, "k").count() == 40
    upserts.write_keys(df.where("n < 20"), path, 0, "k", "r")
    assert upserts.unseen(df, path, 1, "k", "r").count() == 20
    assert upserts.unseen(df, path, 0, "k", "r").count() == 40  # the batch itself, once more
    assert upserts.unseen(df, path, 0, "k", "other").count() == 20
    few = df.where("n = 30")
    text = plan(upserts.unseen(few, path, 1, "k", "r"))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", text)


def test_copies_are_dropped_once(spark, monkeypatch):
    """The hashes of a batch are read from it as it came; copies are sorted out only for the rows."""
    path = new_dir(spark, "seen")
    batch = spark.createDataFrame([(f"k{i % 40}", i) for i in range(80)] + [(None, 0)], "UUID string, n int")
    collected = []
    collect = type(batch).collect

    def watched(self):
        collected.append(plan(self))
        return collect(self)

    monkeypatch.setattr(type(batch), "collect", watched)
    first = sinks.first_seen(path)(batch, 0, "r")
    assert not collected  # nothing has been seen yet
    sinks.remembered(path)(first.where("n < 20"), 0, "r")
    again = sinks.first_seen(path)(batch, 1, "r")
    assert len(collected) == 1 and "Window" not in collected[0]
    assert sorted(r["n"] for r in again.collect()) == [*range(20, 40)]


def test_versions_are_replaced_under_readers(spark):
    path = new_dir(spark, "versions")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    write = lambda n: lambda folder: spark.range(n).write.parquet(folder)
    versions.publish(spark, path, write(1))
    reader = spark.read.parquet(versions.current(spark, path))
    versions.publish(spark, path, write(2))
    assert reader.count() == 1 and spark.read.parquet(versions.current(spark, path)).count() == 2

    def fails(folder):
        spark.range(9).write.parquet(folder)
        raise OSError("disk")

    with pytest.raises(OSError):
        versions.publish(spark, path, fails)
    assert spark.read.parquet(versions.current(spark, path)).count() == 2
    for n in range(3, 9):
        versions.publish(spark, path, write(n), keep=2)
    assert spark.read.parquet(versions.current(spark, path)).count() == 8
    kept = versions.history(spark, path)[:2]
    assert [spark.read.parquet(f"{path}/{v}").count() for v in kept] == [8, 7]
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(f"{path}/{versions.history(spark, path)[2]}").count()
