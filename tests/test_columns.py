"""Edge cases of the column functions."""

import datetime as dt
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.functions import clock, coerce, messages, text
from delaylab.operators import features, learning, serving


def one(spark, column):
    row = spark.range(1).select(column.alias("x"))
    return row.first()["x"]


def lit(value, kind="string"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize("hhmm, expected", [
    ("2430", dt.datetime(2015, 1, 1, 23, 59)),
    ("2400", dt.datetime(2015, 1, 1, 23, 59)),
    ("0905", dt.datetime(2015, 1, 1, 9, 5)),
    ("0005", dt.datetime(2015, 1, 1, 0, 5)),
    ("5", dt.datetime(2015, 1, 1, 0, 5)),
    ("", None), ("0975", None), ("2500", None), ("ab", None), ("12345", None), (None, None),
])
def test_clock(spark, hhmm, expected):
    assert one(spark, clock.hhmm_to_ts(lit("2015-01-01"), lit(hhmm))) == expected


def test_overnight(spark):
    dep = clock.hhmm_to_ts(lit("2015-01-01"), lit("2310"))
    arr = clock.hhmm_to_ts(lit("2015-01-01"), lit("0105"))
    assert one(spark, clock.overnight_arrival(dep, arr)) == dt.datetime(2015, 1, 2, 1, 5)
    assert one(spark, clock.overnight_arrival(arr, dep)) == dt.datetime(2015, 1, 1, 23, 10)


@pytest.mark.parametrize("date, parts", [
    ("2016-12-25", (360, 25, 6)), ("2016-12-31", (366, 31, 5)), ("2015-01-05", (5, 5, 0)),
])
def test_date_parts(spark, date, parts):
    row = spark.range(1).select(*clock.date_parts(lit(date, "date"))).first()
    assert tuple(row) == parts


@pytest.mark.parametrize("minutes, klass", [
    (-15.1, 0.0), (-15.0, 1.0), (-0.5, 1.0), (0.0, 2.0), (29.999, 2.0), (30.0, 3.0), (None, None),
])
def test_delay_class_and_bucketizer_agree(spark, minutes, klass):
    df = spark.createDataFrame([(minutes,)], "ArrDelay double")
    assert df.select(text.delay_class(F.col("ArrDelay"))).first()[0] == klass
    bucketed = learning.bucketize_delay(df).collect()
    assert [r[learning.LABEL] for r in bucketed] == ([] if klass is None else [klass])


def test_bucketize_leaves_out_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "ArrDelay double")
    assert learning.bucketize_delay(df).count() == 1


def test_labels(spark):
    shown = [one(spark, text.delay_label(F.lit(k))) for k in (0.0, 1.0, 2.0, 3.0, 4.0)]
    assert shown == [*text.DELAY_LABELS, None]


def test_route_is_null_where_an_end_is(spark):
    assert one(spark, text.route(lit(None), lit("SFO"))) is None
    assert one(spark, text.route(lit("ATL"), lit("SFO"))) == "ATL-SFO"


@pytest.mark.parametrize("url, place", [
    ("http://h/p?start=0&end=15", "http://h/p"),
    ("http://h/p", "http://h/p"),
    ("http://h/p?start=0", "http://h/p?start=0"),
    ("http://h/p?a=1&start=0&end=15", "http://h/p?a=1&start=0&end=15"),
])
def test_strip_place(spark, url, place):
    assert one(spark, text.strip_place(lit(url))) == place


def test_truncate(spark):
    assert one(spark, text.truncate_label(lit("x" * 20))) == "x" * 14 + "..."
    assert one(spark, text.truncate_label(lit("x" * 14))) == "x" * 14


@pytest.mark.parametrize("value, kind, expected", [
    ("5.5", "double", 5.5), ("about 5", "double", None), ("7", "int", 7), ("7.5", "int", None),
])
def test_coerce(spark, value, kind, expected):
    assert one(spark, coerce.coerce(lit(value), kind)) == expected


def test_json(spark):
    sent = (
        '{"Dest":"ORD","DayOfYear":360,"FlightDate":"2016-12-25","Distance":606.0,'
        '"DayOfMonth":25,"UUID":"u","FlightNum":"2010","Carrier":"AA","DepDelay":-100.0,'
        '"DayOfWeek":6,"Origin":"ATL","Timestamp":"2016-12-10T06:00:52.124389"}'
    )
    df = spark.createDataFrame([(sent,), ("not json",)], "value string")
    rows = df.select(messages.parse_request(F.col("value")).alias("r")).select("r.*").collect()
    assert rows[0]["Distance"] == 606.0 and rows[0]["DayOfWeek"] == 6
    assert rows[0]["Timestamp"] == dt.datetime(2016, 12, 10, 6, 0, 52, 124389)
    assert set(rows[1]) == {None}


def test_stamped_requests_have_distinct_ids(spark):
    stamped = messages.stamp_request(spark.range(50), "a").collect()
    assert len({r["UUID"] for r in stamped}) == 50
    assert all(r["Timestamp"] is not None for r in stamped)


def test_stamps_survive_another_attempt(spark):
    assert one(spark, messages.name_uuid(lit("a/1"))) == str(uuid.UUID(bytes=hashlib.md5(b"a/1").digest(), version=3))
    rows = spark.range(40).withColumn("n", F.col("id") + 5)
    ids = [[r["UUID"] for r in messages.stamp_request(df, "b", "n").orderBy("n").collect()]
           for df in (rows, rows.repartition(5))]
    assert ids[0] == ids[1] and len(set(ids[0])) == 40
    assert not set(ids[0]) & {r["UUID"] for r in messages.stamp_request(rows, "c", "n").collect()}


def test_day_predicate_is_half_open(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2016, 1, 1),), (dt.datetime(2016, 1, 1, 23, 59, 59, 999999),),
         (dt.datetime(2016, 1, 2),)], "t timestamp_ntz",
    )
    assert df.where(clock.within_day(F.col("t"), "2016-01-01")).count() == 2


@pytest.mark.parametrize("start, end, total, expected", [
    (0, 15, 40, (15, 30, True, 0, 0, False)),
    (15, 30, 40, (30, 45, True, 0, 15, True)),
    (30, 45, 40, (45, 60, False, 15, 30, True)),
])
def test_navigation(spark, start, end, total, expected):
    links = serving.navigation(F.lit(start), F.lit(end), 15, F.lit(total))
    assert tuple(spark.range(1).select(*links).first()) == expected


def test_unknown_search_term_is_refused(spark):
    with pytest.raises(ValueError):
        serving.where_terms(spark.range(1), {"id": "1"}, ["Carrier"])


def test_empty_term_does_not_restrict(spark):
    df = spark.createDataFrame([("AA",), ("DL",)], "Carrier string")
    assert serving.where_terms(df, {"Carrier": ""}, ["Carrier"]).count() == 2


def test_extract_counts_bad_clocks_as_null(spark):
    flights = spark.createDataFrame(
        [("1", "2015-01-01", 4, 1, 1, "AA", "A", "B", 1.0, 2.0, 3.0, "zz", "0105")],
        "FlightNum string, FlightDate string, DayOfWeek int, DayofMonth int, Month int, "
        "Carrier string, Origin string, Dest string, Distance double, DepDelay double, "
        "ArrDelay double, CRSDepTime string, CRSArrTime string",
    )
    table = features.extract_features(flights)
    assert table.columns == schemas.FEATURES.names
    assert learning.profile_training(table).nulls == {"CRSDepTime": 1}
