"""Physical plans are the ones the operators promise."""

import pytest
from pyspark.sql import functions as F

from delaylab.operators import aggregates, features, joins, learning, serving
from delaylab.plans import registry
from delaylab.session import materialize, new_dir
from delaylab.sources import readers, testbed, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    path = new_dir(spark, "lake")
    writers.land_flights(testbed.flights(spark, sf_dir), path)
    return readers.read_flights(spark, path, view="on_time_performance")


def test_scan_is_pruned(flights):
    text = plan(aggregates.flights_by_month(flights))
    assert "ReadSchema: struct<Year:int,Month:int>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_feature_extraction_is_one_narrow_stage(flights):
    text = plan(features.extract_features(flights))
    assert "Exchange" not in text and "Python" not in text and "Scan ExistingRDD" not in text
    assert "PushedFilters: [IsNotNull(ArrDelay), IsNotNull(DepDelay)]" in text
    assert "TailNum" not in text
    # Each clock is parsed once although the arrival refers to both more than once.
    assert text.count("as timestamp_ntz)") == 2


def test_sort_is_by_range(flights):
    text = plan(features.sort_features(features.extract_features(flights)))
    assert "rangepartitioning" in text and "SinglePartition" not in text


def test_day_window_reaches_the_scan(spark, sf_dir):
    text = plan(readers.requests_in_window(testbed.requests(spark, sf_dir), "2024-01-15"))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "LessThan(ts,2024-01-16T00:00)" in text


def test_stored_day_is_pruned_to_its_folder(spark, sf_dir):
    path = new_dir(spark, "days")
    requests = registry.prepared_requests(spark, sf_dir)
    writers.write_daily(requests, path)
    text = plan(readers.read_requests_day(spark, path, "2024-01-15"))
    assert "PartitionFilters: [isnotnull(request_date" in text
    results = spark.read.parquet(path)
    assert "PartitionFilters: [isnotnull(request_date" in plan(
        serving.results_on_day(results, "2024-01-15")
    )


def test_distance_join_is_broadcast_by_size_only(spark, sf_dir):
    requests = testbed.requests(spark, sf_dir)
    distances = registry.stored_distances(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(joins.enrich_distance(requests, distances))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(joins.enrich_distance(requests, distances))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_distances_join_only_flights_the_feature_table_leaves_out(spark, sf_dir):
    registry.features_path(spark, sf_dir)
    whole = testbed.flights(spark, sf_dir, "Origin", "Dest", "Distance")
    mine = registry.routed_flights(spark, sf_dir)
    assert "Union" in plan(mine) and "Union" not in plan(whole)
    # The rest is picked by the part's key from the line items, before any join.
    assert "l_partkey" in plan(mine) and "l_partkey" not in plan(whole)
    scans = [line for line in plan(mine).splitlines() if "FileScan" in line and "l_partkey" in line]
    assert len(scans) == 1 and "DataFilters" in scans[0] and "% 50" in scans[0]
    same = [sorted(aggregates.origin_dest_distances(df).collect()) for df in (mine, whole)]
    assert same[0] == same[1]


def test_pages_are_top_k(flights):
    text = plan(serving.search_flights(flights, {"Carrier": "AA"}, start=15))
    assert "TakeOrderedAndProject(limit=30, offset=15" in text
    assert "EqualTo(Carrier,AA)" in text and "rangepartitioning" not in text
    assert "TakeOrderedAndProject" in plan(
        serving.page_after(flights, ["FlightDate", "DepTime"],
                           {"FlightDate": "1997-01-01", "DepTime": "0900"}, 15)
    )
    assert "TakeOrderedAndProject" in plan(
        serving.distance_topk(aggregates.origin_dest_distances(flights), 5)
    )


def test_waiting_requests_are_an_anti_join(spark, sf_dir):
    requests = testbed.requests(spark, sf_dir)
    responses = features.response_projection(
        learning.naive_score(registry.prepared_requests(spark, sf_dir))
    )
    assert "LeftAnti" in plan(joins.pending_requests(requests, responses))


def test_null_profile_is_one_scan(flights):
    assert plan(aggregates.null_profile(flights)).count("FileScan") == 1


def test_label_dictionaries_come_from_one_scan(spark, flights):
    routed = features.derive_route(flights.select("Carrier", "Origin", "Dest"))
    counted = aggregates.index_labels(routed, learning.CATEGORIES)
    assert {r["column_name"] for r in counted.collect()} == set(learning.CATEGORIES)


def test_lookup_joins_without_shuffling_again(spark, flights):
    keys = flights.select("Carrier", "FlightDate", "FlightNum")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup_flights(keys, flights, few=0))
        filtered = plan(joins.lookup_flights(keys, flights))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # One shuffle per side; the window brings no further one, and rows are limited before it.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > text.index("Exchange")
    assert filtered.count("Exchange hashpartitioning") == 2 and "LeftSemi" in filtered
    few = plan(joins.lookup_flights(keys.limit(5), flights))
    assert "BroadcastHashJoin" in few and few.index("WindowGroupLimit") < few.index("BroadcastHashJoin")


def test_four_views_come_from_one_scan(flights):
    rollup = aggregates.FlightRollup(flights)
    counted = rollup._counts
    assert counted.columns[-1] == "of"
    for view, plain in (
        (rollup.flights_by_month(), aggregates.flights_by_month(flights)),
        (rollup.airplanes_per_carrier(7), aggregates.airplanes_per_carrier(flights, 7)),
        (rollup.delay_histogram(), aggregates.delay_histogram(flights)),
        (rollup.delay_class_counts(), aggregates.delay_class_counts(flights)),
    ):
        assert sorted(map(str, view.collect())) == sorted(map(str, plain.collect()))
        assert "lake" not in plan(view)


def test_unused_tables_are_not_joined(spark, sf_dir):
    assert "Join" not in plan(testbed.flights(spark, sf_dir, "Year", "Carrier"))
    assert plan(testbed.flights(spark, sf_dir, "Origin")).count("FileScan") == 2


def test_materialized_rows_are_files(spark):
    df = materialize(spark.range(10).select((F.col("id") % 3).alias("k")), "m")
    assert "FileScan parquet" in plan(df) and df.count() == 10
