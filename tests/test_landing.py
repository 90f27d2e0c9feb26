"""Landing and scoring must not lose or invent rows."""

import pytest
from pyspark.sql import functions as F

from delaylab.operators import learning
from delaylab.plans import jobs
from delaylab.sources import readers, writers


def test_a_line_that_is_no_json_is_no_route(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.jsonl").write_text(
        '{"Origin": "A", "Dest": "B", "Distance": 5}\nnot json\n{"origin": "C", "dest": "D"}\n'
    )
    rows = readers.ingest_distances(spark, str(tmp_path / "lines")).collect()
    assert {(r.origin, r.dest, r.distance) for r in rows} == {("A", "B", 5.0), ("C", "D", 0.0)}


def test_an_emptied_day_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame(
        [(1, "2024-01-15 10:00:00"), (2, "2024-01-16 10:00:00")], "id int, at string"
    ).withColumn("Timestamp", F.to_timestamp_ntz("at")).drop("at")
    writers.write_daily(rows, path)
    writers.write_daily(rows.where("id = 0"), path, day="2024-01-15")
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]
    writers.write_daily(rows, path, day="2024-01-15")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_the_regressor_answers_every_request(spark):
    rows = [("A", "B", str(i % 7), float(i), i % 365, i % 28, i % 7, float(i % 50)) for i in range(200)]
    names = ("Origin string, Dest string, FlightNum string, Distance double, DayOfYear int, "
             "DayOfMonth int, DayOfWeek int, ArrDelay double")
    features = spark.createDataFrame(rows, names)
    model = learning.train_regressor(features)
    asked = features.withColumn("Distance", F.when(F.col("DayOfWeek") > 2, F.col("Distance")))
    found = learning.predict_delay(asked, model).collect()
    assert len(found) == 200
    assert all((r.Delay is None) == (r.Distance is None) for r in found)


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("distance,More,Carrier,FlightDate\n59.0,x,AA,2015-01-02\nfar,y,DL,2015-01-03\n")
    rows = readers.read_flight_files(spark, str(tmp_path)).orderBy("Carrier").collect()
    assert [(r.FlightDate, r.Carrier, r.Distance, r.Origin) for r in rows] == [
        ("2015-01-02", "AA", 59.0, None), ("2015-01-03", "DL", None, None)]


def test_csv_files_are_grouped_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Carrier,Origin,Distance\nAA,ATL,5\nDL,JFK,far\n")
    (tmp_path / "b.csv").write_text("Origin,Note,Carrier\nSFO,\"x,y\",UA\n")
    (tmp_path / "c.csv").write_text("Carrier,Origin,Distance\nWN,LAX,7\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "notes.txt").write_text("Carrier\nXX\n")
    rows = readers.read_flight_files(spark, str(tmp_path)).collect()
    assert sorted((r.Carrier, r.Origin, r.Distance) for r in rows) == sorted(
        [("AA", "ATL", 5.0), ("DL", "JFK", None), ("UA", "SFO", None), ("WN", "LAX", 7.0)], key=str
    )
    counts = jobs.land_flights(spark, str(tmp_path), str(tmp_path / "lake"))
    assert counts == {"rows": 4, "failed_casts": 1}
    (tmp_path / "none").mkdir()
    assert jobs.land_flights(spark, str(tmp_path / "none"), str(tmp_path / "lake2")) == {"rows": 0, "failed_casts": 0}


def test_landing_counts_what_it_rejects(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(
        '{"Origin": "A", "Dest": "B", "Distance": 5}\n\nnot json\n{"origin": "C", "dest": "D", "distance": "x"}\n'
    )
    counts = jobs.land_distances(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "table"))
    assert counts == {"records": 2, "blank": 1, "rejected": 1, "failed_casts": 1}
    held = readers.read_distances(spark, str(tmp_path / "table")).collect()
    assert {(r.Origin, r.Distance) for r in held} == {("A", 5.0), ("C", None)}


def test_rows_of_another_day_are_counted(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "2024-01-15 10:00:00"), (2, "2024-01-16 10:00:00"), (3, None)], "id int, at string"
    ).withColumn("Timestamp", F.to_timestamp_ntz("at")).drop("at")
    assert writers.write_daily(rows, str(tmp_path / "d"), day="2024-01-15") == 2
    assert writers.write_daily(rows.where("id = 1"), str(tmp_path / "d"), day="2024-01-15") == 0
    with pytest.raises(RuntimeError, match="2 rows"):
        jobs._whole_day(2, "2024-01-15")
