"""Groups that hold a third of all rows, copies of one row, and null keys."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from delaylab.operators import aggregates, hotkeys, joins, serving
from delaylab.session import materialize

SCHEMA = (
    "TailNum string, Carrier string, FlightDate string, FlightNum string, Origin string, "
    "Dest string, DepTime string, ArrTime string"
)


def skewed_rows():
    rows = []
    for i in range(600):
        if i % 3 == 0:  # one airplane, and within it copies of a single flight
            rows.append(("HOT", "AA", "2015-01-01", "1", "ATL", "SFO", "0900", "1000"))
        elif i % 3 == 1:  # no airplane is recorded
            rows.append((None, "DL", f"2015-01-{i % 28 + 1:02d}", str(i % 7), "ATL", "SFO",
                         f"{i % 24:02d}00", "2359"))
        else:
            rows.append((f"N{i % 50}", "UA", f"2015-02-{i % 28 + 1:02d}", str(i), "JFK", "ATL",
                         f"{i % 24:02d}30", "2359"))
    return rows


@pytest.fixture(scope="module")
def flights(spark):
    return materialize(
        spark.createDataFrame(skewed_rows(), SCHEMA).repartition(4), "skewed"
    )


@pytest.mark.parametrize("limit", [10, 150, 10_000])
def test_positions_in_groups(flights, limit):
    keys, order = ["TailNum"], ["FlightDate", "FlightNum", "DepTime"]
    numbered = hotkeys.number_rows(flights, keys, [F.col(c) for c in order], "rank", "n", limit)
    groups = defaultdict(list)
    for row in numbered.collect():
        groups[row["TailNum"]].append(row)
    expected = Counter(r[0] for r in skewed_rows())
    assert {k: len(v) for k, v in groups.items()} == dict(expected)
    for key, rows in groups.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert {r["n"] for r in rows} == {expected[key]}
        ordered = [tuple(r[c] for c in order) for r in rows]
        assert ordered == sorted(ordered)


def test_positions_in_the_whole_table(flights):
    order = ["FlightDate", "FlightNum", "DepTime", "TailNum"]
    for stored in (False, True):
        rows = hotkeys.number_rows(
            flights, [], [F.col(c) for c in order], stored=stored
        ).orderBy("rank").collect()
        assert [r["rank"] for r in rows] == list(range(1, 601))
        got = [tuple((r[c] is not None, r[c]) for c in order) for r in rows]
        assert got == sorted(got)


def test_copies_of_one_row_are_spread_over_partitions(spark):
    copies = materialize(spark.range(4000).select(F.lit("x").alias("k")), "copies")
    ranked = hotkeys.number_rows(copies, [], [F.col("k")], stored=True)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 4001))


@pytest.mark.parametrize("limit", [7, 150, 10_000])
def test_documents_hold_every_flight_once(flights, limit):
    documents = aggregates.flights_per_airplane(flights, limit).collect()
    fields = ["Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
    expected = defaultdict(list)
    for row in flights.collect():
        expected[row["TailNum"]].append(tuple(row[f] for f in fields))
    got = defaultdict(list)
    for doc in sorted(documents, key=lambda d: d["Part"]):
        assert len(doc["Flights"]) <= limit
        assert doc["FlightCount"] == len(expected[doc["TailNum"]])
        got[doc["TailNum"]] += [tuple(f) for f in doc["Flights"]]
    assert got == {k: sorted(v) for k, v in expected.items()}


@pytest.mark.parametrize("limit", [3, 10_000])
def test_fleet_documents(flights, limit):
    documents = aggregates.airplanes_per_carrier(flights, limit).collect()
    got = defaultdict(list)
    for doc in sorted(documents, key=lambda d: d["Part"]):
        got[doc["Carrier"]] += doc["TailNumbers"]
    expected = defaultdict(set)
    for row in skewed_rows():
        if row[0]:
            expected[row[1]].add(row[0])
    assert got == {k: sorted(v) for k, v in expected.items()}
    carriers = serving.carrier_list(aggregates.airplanes_per_carrier(flights, limit)).collect()
    assert sorted(r["Carrier"] for r in carriers) == sorted(expected)


def test_route_day_listing(flights):
    listed = serving.list_all_route_days(flights, limit=20).collect()
    assert len(listed) == 600
    hot = [r for r in listed if (r["Origin"], r["FlightDate"]) == ("ATL", "2015-01-01")]
    assert sorted(r["rank"] for r in hot) == list(range(1, len(hot) + 1))
    assert {r["flight_count"] for r in hot} == {len(hot)}


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 5, None), (None, 1, "n"), (None, 3, "m")],
        "k string, at int, v string",
    )
    latest = {r["k"]: r["v"] for r in hotkeys.latest_per_key(df, ["k"], ["at"]).collect()}
    assert latest == {"a": "y", "b": None, None: "m"}
    first = {r["k"]: r["v"] for r in hotkeys.first_per_key(df, ["k"], ["at"]).collect()}
    assert first == {"a": "x", "b": None, None: "n"}


def test_lookup_of_repeated_keys(spark, flights):
    keys = spark.createDataFrame(
        [("AA", "2015-01-01", "1")] * 5 + [("AA", "1999-01-01", "1")],
        "Carrier string, FlightDate string, FlightNum string",
    )
    for few in (0, 100):
        found = joins.lookup_flights(keys, flights, few).collect()
        assert len(found) == 1 and found[0]["TailNum"] == "HOT"
    single = serving.flight_lookup(flights, "AA", "2015-01-01", "1").collect()
    assert len(single) == 1


def test_pages_by_offset_and_by_last_row_agree(spark):
    df = spark.createDataFrame(
        [(None if i % 5 == 0 else i % 3, i) for i in range(40)], "a int, id int"
    )
    names = ["a", "id"]
    order = [F.col(n).asc_nulls_last() for n in names]
    seen, last = [], None
    for start in range(0, 40, 7):
        offset_page = serving.page(df, order, start, 7).orderBy("rank").collect()
        assert [r["rank"] for r in offset_page] == list(range(start + 1, start + len(offset_page) + 1))
        keyed = (
            df.orderBy(*order).limit(7) if last is None
            else serving.page_after(df, names, last, 7)
        ).collect()
        assert [tuple(r)[:2] for r in offset_page] == [tuple(r) for r in keyed]
        last = keyed[-1].asDict()
        seen += keyed
    assert len({r["id"] for r in seen}) == 40


def test_single_listing_has_its_count(flights):
    listed = serving.list_flights(flights, "JFK", "ATL", "2015-02-03").collect()
    assert listed and {r["flight_count"] for r in listed} == {len(listed)}
    times = [(r["DepTime"], r["ArrTime"]) for r in listed]
    assert times == sorted(times)


def test_many_rows_are_sorted_in_more_ranges(spark, monkeypatch):
    """A task sorts some GROUP_ROWS rows, whatever number of partitions the session has."""
    sorted_tables = []

    def watched(df, label):
        stored = materialize(df, label)
        if label == "sorted":
            sorted_tables.append(stored)
        return stored

    monkeypatch.setattr(hotkeys, "GROUP_ROWS", 50)
    monkeypatch.setattr(hotkeys, "materialize", watched)
    rows = materialize(spark.range(2000).select((F.col("id") * 37 % 500).alias("k")), "many")
    ranked = hotkeys.number_rows(rows, [], [F.col("k")], stored=True).orderBy("rank").collect()
    assert [r["k"] for r in ranked] == sorted(k for k in range(500) for _ in range(4))
    assert [r["rank"] for r in ranked] == [*range(1, 2001)]
    parts = sorted_tables[0].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert parts <= 100
