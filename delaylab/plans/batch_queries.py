"""Registered batch queries: scans, sinks, columns, joins, aggregates, ordering."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.functions import clock, coerce, messages, text
from delaylab.operators import aggregates, features, hotkeys, joins, learning, pages, serving
from delaylab.plans import jobs, oracle
from delaylab.plans.registry import (
    fleet_text, flights_text, prepared_requests, query, scorer, stored_distances, stored_features,
)
from delaylab.session import new_dir
from delaylab.sources import readers, testbed, writers

FLIGHTS = ", ".join(schemas.FLIGHTS.names)
FEATURES = ", ".join(schemas.FEATURES.names)
REQUEST = ", ".join(schemas.REQUEST.names)

# Parameters of the lookups below; a day and terms the given tables contain.
DAY = "2024-01-15"
FLIGHT_SEARCH = {"Carrier": "AA"}
AIRPLANE_SEARCH = {"EngineManufacturer": "Eng3"}


# Sources

@query("scan_flights", f"SELECT {FLIGHTS} FROM flights", ["flights"])
def scan_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    testbed.flights(spark, sf_dir).createOrReplaceTempView("on_time")
    return spark.sql(f"SELECT {FLIGHTS} FROM on_time")


@query("scan_features_json", f"SELECT {FEATURES} FROM features", ["features"])
def scan_features_json(spark, sf_dir):
    path = new_dir(spark, "features-json")
    jobs.extract_features(testbed.flights(spark, sf_dir), path, format="json")
    return readers.read_features(spark, path, "json")


@query(
    "scan_requests_day",
    f"SELECT {REQUEST} FROM prepared WHERE CAST(Timestamp AS DATE) = DATE '{DAY}'", ["prepared"],
)
def scan_requests_day(spark, sf_dir):
    path = new_dir(spark, "requests")
    writers.write_daily(prepared_requests(spark, sf_dir), path)
    return readers.read_requests_day(spark, path, DAY)


@query(
    "requests_in_window",
    f"""SELECT UUID, Timestamp, FlightDate, Carrier, FlightNum, Origin, Dest, DepDelay
FROM requests WHERE Timestamp >= TIMESTAMP '{DAY}' AND Timestamp < TIMESTAMP '{DAY}' + INTERVAL 1 DAY""",
    ["requests"],
)
def requests_in_window(spark, sf_dir):
    return readers.requests_in_window(testbed.requests(spark, sf_dir), DAY)


def naive_results(spark, sf_dir) -> DataFrame:
    return learning.naive_score(prepared_requests(spark, sf_dir)).select(*schemas.RESULT.names)


RESULT = ", ".join(schemas.RESULT.names)


@query("scan_results_jsonl", f"SELECT {RESULT} FROM scored", ["scored"])
def scan_results_jsonl(spark, sf_dir):
    path = new_dir(spark, "results-json")
    writers.write_results_lines(naive_results(spark, sf_dir), path)
    return readers.read_results(spark, path)


def distance_lines(spark, sf_dir, path: str) -> list[str]:
    """Stale lines, then current ones among blank lines, lines that are no JSON and odd distances."""
    distances = stored_distances(spark, sf_dir)
    stale = distances.select(F.to_json(F.struct(
        F.col("Origin").alias("origin"), F.col("Dest").alias("dest"),
        (F.col("Distance") + 1000).alias("distance"),
    )).alias("value"))
    current = distances.select(F.explode(F.array(
        F.lit(""), F.to_json(F.struct("Origin", "Dest", "Distance")),
        F.concat(F.lit("not json "), "Origin"),
    )).alias("value"))
    ends = distances.select("Dest").distinct()
    bare = ends.select(F.to_json(F.struct("Dest")).alias("value"))
    odd = ends.select(F.to_json(F.struct(
        F.lit("far").alias("Origin"), "Dest", F.lit("a mile").alias("Distance")
    )).alias("value"))
    stale.write.text(f"{path}/1-stale")
    current.unionByName(bare).unionByName(odd).write.text(f"{path}/2-current")
    return [f"{path}/1-stale", f"{path}/2-current"]


@query(
    "ingest_distances",
    """SELECT Origin AS origin, Dest AS dest, Distance AS distance FROM distances
UNION ALL SELECT '' AS origin, Dest AS dest, 0.0 AS distance FROM (SELECT DISTINCT Dest FROM distances)
UNION ALL SELECT 'far', Dest, NULL FROM (SELECT DISTINCT Dest FROM distances)""",
    ["distances"],
)
def ingest_distances(spark, sf_dir):
    path = new_dir(spark, "distance-lines")
    return readers.ingest_distances(spark, distance_lines(spark, sf_dir, path))


def flight_files(spark, sf_dir, path: str) -> None:
    """CSV files of two layouts; one is turned round, has a further column and odd distances."""
    flights = testbed.flights(spark, sf_dir)
    one = F.col("Carrier") == "AA"
    writers.write_flights_csv(flights.where(~one), f"{path}/plain")
    distance = F.when(F.col("FlightNum").cast("int") < 100, "far").otherwise(F.col("Distance").cast("string"))
    turned = flights.where(one).withColumns({"Distance": distance, "Remark": F.lit("x,\"y\"")})
    writers.write_flights_csv(turned.select(*reversed(turned.columns)), f"{path}/turned")


@query(
    "ingest_flights_csv",
    f"""SELECT {FLIGHTS.replace("Distance", "CASE WHEN Carrier = 'AA' AND CAST(FlightNum AS INT) < 100 THEN NULL ELSE Distance END AS Distance")}
FROM flights""",
    ["flights"],
)
def ingest_flights_csv(spark, sf_dir):
    """Files of different headers in one directory, landed together."""
    path = new_dir(spark, "flights")
    flight_files(spark, sf_dir, f"{path}/csv")
    jobs.land_flights(spark, f"{path}/csv/*", f"{path}/lake")
    return readers.read_flights(spark, f"{path}/lake")


@query(
    "landing_counts",
    """SELECT 'flights' AS source, 'rows' AS what, count(*) AS n FROM flights
UNION ALL SELECT 'flights', 'failed_casts', count(*) FROM flights WHERE Carrier = 'AA' AND CAST(FlightNum AS INT) < 100
UNION ALL SELECT 'distances', 'records', 2 * count(*) + 2 * count(DISTINCT Dest) FROM distances
UNION ALL SELECT 'distances', 'blank', count(*) FROM distances
UNION ALL SELECT 'distances', 'rejected', count(*) FROM distances
UNION ALL SELECT 'distances', 'failed_casts', count(DISTINCT Dest) FROM distances""",
    ["distances"],
)
def landing_counts(spark, sf_dir):
    """What landing took and rejected, counted in the pass that lands it."""
    path = new_dir(spark, "landing")
    flight_files(spark, sf_dir, f"{path}/csv")
    counts = {
        "flights": jobs.land_flights(spark, f"{path}/csv/*", f"{path}/lake"),
        "distances": jobs.land_distances(
            spark, distance_lines(spark, sf_dir, path), f"{path}/distances"
        ),
    }
    rows = [(source, what, n) for source, own in counts.items() for what, n in own.items()]
    return spark.createDataFrame(rows, "source string, what string, n long")


# Sinks

@query("write_features", f"SELECT {FEATURES} FROM features", ["features"])
def write_features(spark, sf_dir):
    path = new_dir(spark, "features")
    writers.write_features(features.extract_features(testbed.flights(spark, sf_dir)), path)
    return readers.read_features(spark, path)


EMPTIED = "2024-01-16"


@query(
    "write_daily_partition",
    f"""SELECT UUID, Timestamp, CAST(CAST(Timestamp AS DATE) AS VARCHAR) AS request_date,
  CASE WHEN CAST(Timestamp AS DATE) = DATE '{DAY}' THEN DepDelay ELSE DepDelay - 1 END AS DepDelay
FROM requests WHERE CAST(Timestamp AS DATE) <> DATE '{EMPTIED}'""",
    ["requests"],
)
def write_daily_partition(spark, sf_dir):
    """All days are stored, one is replaced and one emptied; the others must not change."""
    path = new_dir(spark, "daily")
    requests = testbed.requests(spark, sf_dir).select("UUID", "Timestamp", "DepDelay")
    writers.write_daily(requests.withColumn("DepDelay", F.col("DepDelay") - 1), path)
    writers.write_daily(readers.requests_in_window(requests, DAY), path)
    none = readers.requests_in_window(requests, EMPTIED).where(F.col("UUID").isNull())
    writers.write_daily(none, path, day=EMPTIED)
    return spark.read.parquet(path)


@query("append_results", f"SELECT {RESULT} FROM scored", ["scored"])
def append_results(spark, sf_dir):
    path = new_dir(spark, "results")
    results = naive_results(spark, sf_dir)
    split = F.lit(DAY).cast("timestamp_ntz")
    writers.append_results(results.where(F.col("Timestamp") < split), path)
    writers.append_results(results.where(F.col("Timestamp") >= split), path)
    return spark.read.schema(schemas.RESULT).parquet(path)


# Projections, filters and lookups

@query(
    "project_features",
    """SELECT FlightNum, FlightDate, DayOfWeek, DayofMonth AS DayOfMonth,
  CAST(Month AS VARCHAR) || '-' || CAST(DayofMonth AS VARCHAR) AS DayOfYear, Carrier, Origin, Dest,
  Distance, DepDelay, ArrDelay, CRSDepTime, CRSArrTime FROM flights""",
    ["flights"],
)
def project_features(spark, sf_dir):
    return features.project_features(testbed.flights(spark, sf_dir))


@query(
    "filter_complete",
    """SELECT FlightDate, FlightNum, TailNum, DepDelay, ArrDelay FROM flights
WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL""",
    ["flights"],
)
def filter_complete(spark, sf_dir):
    wanted = ["FlightDate", "FlightNum", "TailNum", "DepDelay", "ArrDelay"]
    return features.filter_complete(testbed.flights(spark, sf_dir, *wanted))


@query(
    "derive_route",
    """SELECT FlightDate, FlightNum, Origin, Dest, Origin || '-' || Dest AS Route FROM flights""",
    ["flights"],
)
def derive_route(spark, sf_dir):
    return features.derive_route(
        testbed.flights(spark, sf_dir, "FlightDate", "FlightNum", "Origin", "Dest")
    )


@query("flatten_request", f"SELECT {REQUEST} FROM prepared", ["prepared"])
def flatten_request(spark, sf_dir):
    nested = prepared_requests(spark, sf_dir).select(
        F.struct(*schemas.REQUEST.names).alias("flight")
    )
    return features.flatten(nested, "flight")


@query(
    "strip_ml_columns",
    f"SELECT {REQUEST}, Route, 1 AS classified FROM scored", ["scored"],
)
def strip_ml_columns(spark, sf_dir):
    """All that the stored model adds to a request, without its intermediate columns."""
    model = scorer(spark, sf_dir)
    routed = features.derive_route(prepared_requests(spark, sf_dir))
    stripped = features.strip_ml_columns(model.transform(routed))
    classified = F.col("Prediction").isin(0, 1, 2, 3)
    return stripped.withColumn("classified", classified).drop("Prediction")


@query(
    "response_projection",
    'SELECT uuid, origin, dest, carrier, flight_date, dep_delay, distance, prediction, "timestamp" '
    "FROM responses",
    ["responses"],
)
def response_projection(spark, sf_dir):
    return features.response_projection(naive_results(spark, sf_dir))


@query(
    "flight_lookup",
    f"""SELECT {FLIGHTS} FROM (SELECT *, row_number() OVER (PARTITION BY Carrier, FlightDate, FlightNum
  ORDER BY DepTime, ArrTime, Origin, Dest, TailNum, Distance, DepDelay NULLS FIRST,
    ArrDelay NULLS FIRST, CRSDepTime, CRSArrTime, AirTime) AS n FROM flights) WHERE n = 1""",
    ["flights"],
)
def flight_lookup(spark, sf_dir):
    """Every flight key looked up at once."""
    keys = testbed.flights(spark, sf_dir, "Carrier", "FlightDate", "FlightNum")
    return joins.lookup_flights(keys, testbed.flights(spark, sf_dir))


@query(
    "flights_on_route_day",
    f"""SELECT {FLIGHTS}, row_number() OVER (PARTITION BY Origin, Dest, FlightDate ORDER BY DepTime, ArrTime,
    Year, Month, DayofMonth, DayOfWeek, Carrier, FlightNum, TailNum, Distance, DepDelay, ArrDelay,
    CRSDepTime, CRSArrTime, AirTime) AS rank,
  count(*) OVER (PARTITION BY Origin, Dest, FlightDate) AS flight_count FROM flights""",
    ["flights"],
)
def flights_on_route_day(spark, sf_dir):
    return serving.list_all_route_days(testbed.flights(spark, sf_dir))


@query(
    "results_on_day",
    f"SELECT {RESULT} FROM scored WHERE CAST(Timestamp AS DATE) = DATE '{DAY}'", ["scored"],
)
def results_on_day(spark, sf_dir):
    return serving.results_on_day(naive_results(spark, sf_dir), DAY)


@query(
    "search_flights",
    f"""SELECT {FLIGHTS}, n AS rank, total FROM (SELECT *, row_number() OVER (ORDER BY FlightDate,
    DepTime, Carrier, FlightNum, Year, Month, DayofMonth, DayOfWeek, TailNum, Origin, Dest, Distance,
    DepDelay, ArrDelay, CRSDepTime, CRSArrTime, ArrTime, AirTime) AS n, count(*) OVER () AS total
  FROM flights WHERE Carrier = 'AA') WHERE n > 15 AND n <= 30""",
    ["flights"],
)
def search_flights(spark, sf_dir):
    return serving.search_flights(testbed.flights(spark, sf_dir), FLIGHT_SEARCH, start=15)


AIRPLANES = ", ".join(schemas.AIRPLANES.names)


@query(
    "search_airplanes",
    f"""SELECT {AIRPLANES}, n AS rank, total FROM (SELECT *, row_number() OVER (ORDER BY Owner, TailNum)
    AS n, count(*) OVER () AS total FROM airplanes WHERE EngineManufacturer = 'Eng3') WHERE n <= 5""",
    ["airplanes"],
)
def search_airplanes(spark, sf_dir):
    return serving.search_airplanes(testbed.airplanes(spark, sf_dir), AIRPLANE_SEARCH)


def form_text(spark, sf_dir) -> DataFrame:
    """Requests as form text, with some delays no number can be read from."""
    number = F.col("DepDelay").cast("int").cast("string")
    delay = (
        F.when(F.col("Carrier") == "AA", F.concat(number, F.lit(".5")))
        .when(F.col("Carrier") == "DL", F.concat(F.lit("about "), number))
        .otherwise(number)
    )
    return testbed.requests(spark, sf_dir).select(
        "UUID", delay.alias("DepDelay"), "Carrier", F.col("FlightDate").cast("string"),
        "Dest", "FlightNum", "Origin",
    )


@query(
    "coerce_request_fields",
    """SELECT UUID, Carrier, FlightDate, Dest, FlightNum, Origin,
  CASE Carrier WHEN 'DL' THEN NULL
    WHEN 'AA' THEN CAST(CAST(CAST(DepDelay AS INT) AS VARCHAR) || '.5' AS DOUBLE) ELSE DepDelay END AS DepDelay,
  CASE WHEN Carrier IN ('AA', 'DL') THEN NULL ELSE CAST(DepDelay AS INT) END AS DepDelayMinutes
FROM requests""",
    ["requests"],
)
def coerce_request_fields(spark, sf_dir):
    form = form_text(spark, sf_dir)
    whole = coerce.coerce(F.col("DepDelay"), coerce.REGRESS_FIELDS["DepDelay"])
    return form.select(
        "UUID", *coerce.coerce_fields(coerce.CLASSIFY_FIELDS), whole.alias("DepDelayMinutes")
    )


@query(
    "airplane_flights",
    """SELECT a.TailNum, f.FlightCount, f.Part, f.Flights FROM airplanes a
LEFT JOIN airplane_flights f ON a.TailNum = f.TailNum""",
    ["airplanes", "airplane_flights"],
)
def airplane_flights(spark, sf_dir):
    fields = ["TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
    documents = aggregates.flights_per_airplane(testbed.flights(spark, sf_dir, *fields))
    return flights_text(joins.lookup_airplanes(testbed.airplanes(spark, sf_dir), documents))


@query("carrier_list", "SELECT DISTINCT Carrier FROM flights", ["flights"])
def carrier_list(spark, sf_dir):
    return serving.carriers(testbed.flights(spark, sf_dir, "Carrier", "TailNum"))


# Joins

@query(
    "enrich_distance",
    """SELECT UUID, Timestamp, FlightDate, Carrier, FlightNum, Origin, Dest, DepDelay, Distance,
  CAST(distance_missing AS INT) AS distance_missing FROM prepared""",
    ["prepared"],
)
def enrich_distance(spark, sf_dir):
    return joins.enrich_distance(testbed.requests(spark, sf_dir), stored_distances(spark, sf_dir))


@query(
    "airline_profile",
    """SELECT a.CarrierCode, a.Name, a.url, a.domain, a.logo_url, a.summary,
  f.FleetCount, f.Part, f.TailNumbers
FROM airlines a LEFT JOIN fleet f ON a.CarrierCode = f.Carrier""",
    ["airlines", "fleet"],
)
def airline_profile(spark, sf_dir):
    fleet = aggregates.airplanes_per_carrier(testbed.flights(spark, sf_dir, "Carrier", "TailNum"))
    return fleet_text(joins.airline_profile(testbed.airlines(spark, sf_dir), fleet))


def naive_responses(spark, sf_dir) -> DataFrame:
    """Responses to the requests that were answered."""
    answered = naive_results(spark, sf_dir).join(testbed.responded(spark, sf_dir), "UUID", "semi")
    return features.response_projection(answered)


@query(
    "response_status",
    """SELECT r.UUID AS id, CASE WHEN s.uuid IS NULL THEN 'WAIT' ELSE 'OK' END AS status,
  CAST(s.prediction AS VARCHAR) AS prediction
FROM requests r LEFT JOIN (SELECT uuid, prediction FROM responses JOIN requests USING (uuid)
  WHERE requests.responded) s ON r.UUID = s.uuid""",
    ["responses"],
)
def response_status(spark, sf_dir):
    status = joins.response_status(
        testbed.requests(spark, sf_dir), naive_responses(spark, sf_dir)
    )
    return status.withColumn("prediction", F.col("prediction").cast("string"))


@query(
    "pending_requests",
    """SELECT UUID, Timestamp, FlightDate, Carrier, FlightNum, Origin, Dest, DepDelay
FROM requests WHERE NOT responded""",
    ["requests"],
)
def pending_requests(spark, sf_dir):
    return joins.pending_requests(
        testbed.requests(spark, sf_dir), naive_responses(spark, sf_dir)
    )


# Aggregates

@query("origin_dest_distances", "SELECT Origin, Dest, Distance FROM distances", ["distances"])
def origin_dest_distances(spark, sf_dir):
    return aggregates.origin_dest_distances(
        testbed.flights(spark, sf_dir, "Origin", "Dest", "Distance")
    )


@query(
    "null_profile",
    "SELECT column_name, null_count FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM flights WHERE {c} IS NULL"
        for c in schemas.FLIGHTS.names
    ) + ") WHERE null_count > 0",
    ["flights"],
)
def null_profile(spark, sf_dir):
    return aggregates.null_profile(testbed.flights(spark, sf_dir))


@query(
    "prediction_counts",
    'SELECT Prediction, count(*) AS "count" FROM scored GROUP BY Prediction', ["scored"],
)
def prediction_counts(spark, sf_dir):
    return aggregates.prediction_counts(naive_results(spark, sf_dir))


@query(
    "table_counts",
    """SELECT 'flights' AS table_name, count(*) AS row_count FROM flights
UNION ALL SELECT 'requests', count(*) FROM requests
UNION ALL SELECT 'origin_dest_distances', count(*) FROM distances
UNION ALL SELECT 'flight_delay_ml_response', count(*) FROM requests WHERE responded""",
    ["distances", "requests"],
)
def table_counts(spark, sf_dir):
    return aggregates.table_counts({
        "flights": testbed.flights(spark, sf_dir),
        "requests": testbed.requests(spark, sf_dir),
        "origin_dest_distances": stored_distances(spark, sf_dir),
        "flight_delay_ml_response": naive_responses(spark, sf_dir),
    })


@query(
    "flights_by_month",
    """SELECT Year, Month, count(*) AS total_flights, row_number() OVER (ORDER BY Year, Month) AS rank
FROM flights GROUP BY Year, Month""",
    ["flights"],
)
def flights_by_month(spark, sf_dir):
    totals = aggregates.flights_by_month(testbed.flights(spark, sf_dir, "Year", "Month"))
    return serving.monthly_listing(totals)


@query(
    "airplanes_per_carrier",
    "SELECT Carrier, FleetCount, Part, TailNumbers FROM fleet", ["fleet"],
)
def airplanes_per_carrier(spark, sf_dir):
    flights = testbed.flights(spark, sf_dir, "Carrier", "TailNum")
    return fleet_text(aggregates.airplanes_per_carrier(flights))


@query(
    "flights_per_airplane",
    "SELECT TailNum, FlightCount, Part, Flights FROM airplane_flights", ["airplane_flights"],
)
def flights_per_airplane(spark, sf_dir):
    fields = ["TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
    return flights_text(aggregates.flights_per_airplane(testbed.flights(spark, sf_dir, *fields)))


@query(
    "manufacturer_totals",
    """SELECT Manufacturer, Total, row_number() OVER (ORDER BY Total DESC, Manufacturer) AS rank
FROM (SELECT Manufacturer, count(*) AS Total FROM airplanes GROUP BY Manufacturer)""",
    ["airplanes"],
)
def manufacturer_totals(spark, sf_dir):
    totals = aggregates.manufacturer_totals(testbed.airplanes(spark, sf_dir))
    return serving.ranked_manufacturers(totals)


@query(
    "delay_histogram",
    """SELECT CAST(floor(ArrDelay / 15) * 15 AS INT) AS label, count(*) AS value
FROM flights WHERE ArrDelay IS NOT NULL GROUP BY 1""",
    ["flights"],
)
def delay_histogram(spark, sf_dir):
    return aggregates.delay_histogram(testbed.flights(spark, sf_dir, "ArrDelay"))


@query(
    "classification_accuracy",
    f"""SELECT avg(CASE WHEN {oracle.delay_class('DepDelay')} = {oracle.delay_class('ArrDelay')}
  THEN 1.0 ELSE 0.0 END) AS accuracy FROM features""",
    ["features"],
)
def classification_accuracy(spark, sf_dir):
    flights = testbed.flights(spark, sf_dir, "ArrDelay", "DepDelay")
    return aggregates.classification_accuracy(
        features.filter_complete(flights),
        text.delay_class(F.col("DepDelay")), text.delay_class(F.col("ArrDelay")),
    )


@query(
    "index_labels",
    """SELECT column_name, label, n,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx
FROM (SELECT column_name, label, count(*) AS n FROM (
    SELECT 'Carrier' AS column_name, Carrier AS label FROM flights
    UNION ALL SELECT 'Origin', Origin FROM flights UNION ALL SELECT 'Dest', Dest FROM flights
    UNION ALL SELECT 'Route', Origin || '-' || Dest FROM flights) GROUP BY 1, 2)""",
    ["flights"],
)
def index_labels(spark, sf_dir):
    routed = features.derive_route(testbed.flights(spark, sf_dir, "Carrier", "Origin", "Dest"))
    return aggregates.index_labels(routed, learning.CATEGORIES)


@query(
    "topic_offsets",
    """SELECT topic, part AS "partition", count(*) AS messages, max(off) + 1 AS next_offset
FROM message_log GROUP BY topic, part""",
    ["message_log"],
)
def topic_offsets(spark, sf_dir):
    return aggregates.topic_offsets(testbed.message_log(spark, sf_dir))


# Ordering, pages, samples, sets

@query(
    "sorted_features",
    f"""SELECT {FEATURES}, row_number() OVER (ORDER BY DayOfYear, Carrier, Origin, Dest, FlightNum,
  CRSDepTime, CRSArrTime, ArrDelay, DayOfMonth, DayOfWeek, DepDelay, Distance, FlightDate) AS rank
FROM features""",
    ["features"],
)
def sorted_features(spark, sf_dir):
    rest = [c for c in schemas.FEATURES.names if c not in features.FEATURE_ORDER]
    order = [F.col(c) for c in features.FEATURE_ORDER + rest]
    return hotkeys.number_rows(stored_features(spark, sf_dir), [], order, stored=True)


@query(
    "distance_topk",
    """SELECT 'longest' AS listing, Origin, Dest, Distance, row_number() OVER (ORDER BY Distance DESC, Origin, Dest) AS rank
FROM distances QUALIFY rank <= 25
UNION ALL SELECT 'shortest' AS listing, Origin, Dest, Distance, row_number() OVER (ORDER BY Distance, Origin, Dest) AS rank
FROM distances QUALIFY rank <= 25""",
    ["distances"],
)
def distance_topk(spark, sf_dir):
    distances = stored_distances(spark, sf_dir)
    longest = serving.distance_topk(distances, 25).withColumn("listing", F.lit("longest"))
    shortest = serving.distance_topk(distances, 25, longest=False)
    return longest.unionByName(shortest.withColumn("listing", F.lit("shortest")))


@query(
    "paginate",
    f"""SELECT {AIRPLANES}, n AS rank, total, start + 5 AS next_bottom, start + 10 AS next_top,
  CAST(total > start + 5 AS INT) AS next_link, greatest(start - 5, 0) AS previous_bottom,
  start AS previous_top, CAST(start > 0 AND total > greatest(start - 5, 0) AS INT) AS previous_link
FROM (SELECT *, row_number() OVER (ORDER BY Owner, TailNum) AS n, count(*) OVER () AS total,
    CAST(10 AS INT) AS start FROM airplanes)
WHERE n > start AND n <= start + 5""",
    ["airplanes"],
)
def paginate(spark, sf_dir):
    start, step = 10, serving.AIRPLANES_PER_PAGE
    listed = serving.search_airplanes(testbed.airplanes(spark, sf_dir), {}, start)
    links = serving.navigation(F.lit(start), F.lit(start + step), step, F.col("total"))
    return listed.select("*", *links)


DEEP, DEEP_BLOCK = 5000, 1000


@query(
    "paginate_deep",
    f"""SELECT {FLIGHTS}, n AS rank, total FROM (SELECT *, row_number() OVER (ORDER BY FlightDate,
    DepTime, Carrier, FlightNum, Year, Month, DayofMonth, DayOfWeek, TailNum, Origin, Dest, Distance,
    DepDelay, ArrDelay, CRSDepTime, CRSArrTime, ArrTime, AirTime) AS n, count(*) OVER () AS total
  FROM flights) WHERE n > {DEEP} AND n <= {DEEP} + 15""",
    ["flights"],
)
def paginate_deep(spark, sf_dir):
    """A page far down the listing of all flights, from the block that it lies in."""
    path = new_dir(spark, "listing")
    flights = testbed.flights(spark, sf_dir)
    pages.store_listing(flights, serving.FLIGHT_SORT, path, DEEP_BLOCK)
    return pages.read_page(spark, path, DEEP, serving.FLIGHTS_PER_PAGE)


@query(
    "sample_features",
    f"""SELECT FlightNum, FlightDate, DayOfWeek, DayofMonth AS DayOfMonth,
  CAST(Month AS VARCHAR) || '-' || CAST(DayofMonth AS VARCHAR) AS DayOfYear, Carrier, Origin, Dest,
  Distance, DepDelay, ArrDelay, CRSDepTime, CRSArrTime FROM flights
WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL
  AND substr(md5(concat_ws('|', {", ".join(learning.FLIGHT_KEY)})), 1, 8) < '{round(0.1 * 0x100000000):08x}'""",
    ["flights"],
)
def sample_features(spark, sf_dir):
    """A tenth of the flights, as the feature job may take them, drawn by their key."""
    projected = features.project_features(testbed.flights(spark, sf_dir))
    return features.filter_complete(features.sample_by_key(projected, learning.FLIGHT_KEY, 10))


@query("distinct_routes", "SELECT DISTINCT Origin, Dest FROM flights", ["flights"])
def distinct_routes(spark, sf_dir):
    return aggregates.distinct_routes(testbed.flights(spark, sf_dir, "Origin", "Dest"))


# Column functions

@query(
    "hhmm_to_ts",
    f"""SELECT FlightDate, TailNum, FlightNum, short, {oracle.clock('FlightDate', 'short')} AS departs
FROM (SELECT *, CASE WHEN CRSDepTime LIKE '000%' THEN substr(CRSDepTime, 4)
  WHEN CRSDepTime LIKE '00%' THEN substr(CRSDepTime, 3)
  WHEN CRSDepTime LIKE '0%' THEN substr(CRSDepTime, 2) ELSE CRSDepTime END AS short FROM flights)""",
    ["flights"],
)
def hhmm_to_ts(spark, sf_dir):
    flights = testbed.flights(spark, sf_dir, "FlightDate", "TailNum", "FlightNum", "CRSDepTime")
    short = F.regexp_replace("CRSDepTime", "^0{1,3}", "")
    return flights.select("FlightDate", "TailNum", "FlightNum", short.alias("short")).withColumn(
        "departs", clock.hhmm_to_ts(F.col("FlightDate"), F.col("short"))
    )


@query(
    "overnight_arrival",
    f"""SELECT FlightDate, TailNum, FlightNum, dep AS departs,
  CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS arrives
FROM (SELECT *, {oracle.clock('FlightDate', 'CRSDepTime')} AS dep,
  {oracle.clock('FlightDate', 'CRSArrTime')} AS arr FROM flights)""",
    ["flights"],
)
def overnight_arrival(spark, sf_dir):
    flights = testbed.flights(
        spark, sf_dir, "FlightDate", "TailNum", "FlightNum", "CRSDepTime", "CRSArrTime"
    )
    departs = clock.hhmm_to_ts(F.col("FlightDate"), F.col("CRSDepTime"))
    arrives = clock.hhmm_to_ts(F.col("FlightDate"), F.col("CRSArrTime"))
    return flights.select(
        "FlightDate", "TailNum", "FlightNum", departs.alias("departs"),
        clock.overnight_arrival(departs, arrives).alias("arrives"),
    )


@query(
    "date_parts",
    """SELECT FlightDate, TailNum, FlightNum, CAST(dayofyear(CAST(FlightDate AS DATE)) AS INT) AS DayOfYear,
  CAST(day(CAST(FlightDate AS DATE)) AS INT) AS DayOfMonth,
  CAST(isodow(CAST(FlightDate AS DATE)) - 1 AS INT) AS DayOfWeek FROM flights""",
    ["flights"],
)
def date_parts(spark, sf_dir):
    flights = testbed.flights(spark, sf_dir, "FlightDate", "TailNum", "FlightNum")
    return features.with_date_parts(flights)


@query(
    "day_window",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_start,
  CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS day_end FROM events""",
)
def day_window(spark, sf_dir):
    start, end = clock.day_window(F.col("ts"))
    return testbed.table(spark, sf_dir, "events").select(
        "event_id", start.alias("day_start"), end.alias("day_end")
    )


@query(
    "typed_casts",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INT) END AS number,
  props AS message FROM events""",
)
def typed_casts(spark, sf_dir):
    """Text to numbers, where the text of failed events is no number; bytes to text."""
    written = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.col("user_id").cast("string")
    )
    events = testbed.table(spark, sf_dir, "events").select(
        "event_id", written.alias("written"), F.encode("props", "utf-8").alias("raw")
    )
    return events.select(
        "event_id", coerce.coerce(F.col("written"), "int").alias("number"),
        F.col("raw").cast("string").alias("message"),
    )


@query(
    "delay_bucket_label",
    f"""SELECT FlightDate, TailNum, FlightNum, ArrDelay, {oracle.delay_label(oracle.delay_class('ArrDelay'))} AS label
FROM flights WHERE ArrDelay IS NOT NULL""",
    ["flights"],
)
def delay_bucket_label(spark, sf_dir):
    flights = testbed.flights(spark, sf_dir, "FlightDate", "TailNum", "FlightNum", "ArrDelay")
    label = text.delay_label(text.delay_class(F.col("ArrDelay")))
    return flights.where(F.col("ArrDelay").isNotNull()).withColumn("label", label)


@query("request_message", f"SELECT {REQUEST} FROM prepared", ["prepared"])
def request_message(spark, sf_dir):
    """Requests as JSON text, read back key by key."""
    sent = prepared_requests(spark, sf_dir).select(messages.request_message().alias("message"))
    fields = [
        F.get_json_object("message", f"$.{f.name}").cast(f.dataType).alias(f.name)
        for f in schemas.REQUEST.fields
    ]
    return sent.select(*fields)


@query(
    "stamp_requests",
    """SELECT d[1:8] || '-' || d[9:12] || '-3' || d[14:16] || '-'
  || substr('89ab', CAST((strpos('0123456789abcdef', d[17:17]) - 1) % 4 + 1 AS INT), 1)
  || d[18:20] || '-' || d[21:32] AS UUID, event_id, TIMESTAMP '2024-02-01 12:00:00' AS Timestamp,
  1 AS copies, 2 AS attempts
FROM (SELECT event_id, md5('form/' || CAST(event_id AS VARCHAR)) AS d FROM events)""",
)
def stamp_requests(spark, sf_dir):
    """New requests get identifiers and a time, twice; both attempts give the same, all unique."""
    rows = testbed.table(spark, sf_dir, "events").select("event_id")
    at = datetime(2024, 2, 1, 12)
    attempts = [messages.stamp_request(rows, "form", "event_id", at) for _ in range(2)]
    both = attempts[0].unionByName(attempts[1].repartition(3))
    return both.groupBy("UUID", "Timestamp").agg(
        F.min("event_id").alias("event_id"), F.count_distinct("event_id").alias("copies"),
        F.count(F.lit(1)).alias("attempts"),
    )


@query(
    "json_parse",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
  ELSE CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INT) END AS k FROM events""",
)
def json_parse(spark, sf_dir):
    """JSON to a typed struct; the text of failed events is cut short and gives nulls."""
    sent = F.when(F.col("event_type") == "error", F.substring("props", 1, 3)).otherwise(
        F.col("props")
    )
    parsed = messages.parse(sent, "k INT")
    return testbed.table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "strip_place",
    """SELECT page_id, url AS link FROM pages
UNION ALL SELECT page_id, CASE WHEN contains(url, '?') THEN url || '&start=0&end=15' ELSE url END AS link FROM pages""",
)
def strip_place(spark, sf_dir):
    """Page links as they are, and with paging parameters; those after another stay."""
    pages = testbed.table(spark, sf_dir, "pages").select("page_id", "url")
    mark = F.when(F.col("url").contains("?"), "&").otherwise("?")
    placed = pages.withColumn("url", F.concat("url", mark, F.lit("start=0&end=15")))
    return pages.unionByName(placed).select("page_id", text.strip_place(F.col("url")).alias("link"))


@query(
    "truncate_label",
    """SELECT p_partkey, CASE WHEN length(t) > 14 THEN substr(t, 1, 14) || '...' ELSE t END AS label
FROM (SELECT p_partkey, p_brand || ' ' || p_type AS t FROM part)""",
)
def truncate_label(spark, sf_dir):
    name = F.concat_ws(" ", "p_brand", "p_type")
    return testbed.table(spark, sf_dir, "part").select(
        "p_partkey", text.truncate_label(name).alias("label")
    )


# Jobs without a model

@query("job_extract_features", f"SELECT {FEATURES} FROM features", ["features"])
def job_extract_features(spark, sf_dir):
    path = new_dir(spark, "job-features")
    jobs.extract_features(testbed.flights(spark, sf_dir), path)
    return readers.read_features(spark, path)


@query("job_build_distances", "SELECT Origin, Dest, Distance FROM distances", ["distances"])
def job_build_distances(spark, sf_dir):
    path = new_dir(spark, "job-distances")
    jobs.build_distances(testbed.flights(spark, sf_dir, "Origin", "Dest", "Distance"), path)
    return readers.read_distances(spark, path)


_FLEET_LIST = "CAST(FleetCount AS VARCHAR) || ' ' || md5(TailNumbers)"
_FLIGHT_LIST = "CAST(FlightCount AS VARCHAR) || ' ' || md5(Flights)"


@query(
    "job_build_serving_views",
    f"""SELECT 'flights_by_month' AS view, CAST(Year AS VARCHAR) || '-' || CAST(Month AS VARCHAR) AS "key",
  CAST(count(*) AS VARCHAR) AS "value" FROM flights GROUP BY Year, Month
UNION ALL SELECT 'airplanes_per_carrier', Carrier || ' ' || CAST(Part AS VARCHAR), {_FLEET_LIST} FROM fleet
UNION ALL SELECT 'flights_per_airplane', TailNum || ' ' || CAST(Part AS VARCHAR), {_FLIGHT_LIST} FROM airplane_flights
UNION ALL SELECT 'manufacturer_totals', Manufacturer, CAST(count(*) AS VARCHAR) FROM airplanes GROUP BY Manufacturer
UNION ALL SELECT 'delay_histogram', CAST(CAST(floor(ArrDelay / 15) * 15 AS INT) AS VARCHAR), CAST(count(*) AS VARCHAR)
  FROM flights WHERE ArrDelay IS NOT NULL GROUP BY floor(ArrDelay / 15)
UNION ALL SELECT 'delay_class_counts', {oracle.delay_label(oracle.delay_class('ArrDelay'))}, CAST(count(*) AS VARCHAR)
  FROM flights WHERE ArrDelay IS NOT NULL GROUP BY 2""",
    ["fleet", "airplane_flights", "airplanes"],
)
def job_build_serving_views(spark, sf_dir):
    """Everything the six stored views hold, as keys and values; lists by their count and digest."""
    path = new_dir(spark, "views")
    writers.land_flights(testbed.flights(spark, sf_dir), f"{path}/flights")
    jobs.build_serving_views(
        readers.read_flights(spark, f"{path}/flights"), testbed.airplanes(spark, sf_dir), path
    )

    def view(name, *keys, value, prepare=lambda df: df):
        held = prepare(spark.read.parquet(f"{path}/{name}"))
        key = F.concat_ws("-" if "Year" in keys else " ", *[F.col(k).cast("string") for k in keys])
        return held.select(F.lit(name).alias("view"), key.alias("key"), value.cast("string").alias("value"))

    def listed(count, items):
        return F.concat_ws(" ", F.col(count).cast("string"), F.md5(items))

    parts = [
        view("flights_by_month", "Year", "Month", value=F.col("total_flights")),
        view("airplanes_per_carrier", "Carrier", "Part", value=listed("FleetCount", "TailNumbers"),
             prepare=fleet_text),
        view("flights_per_airplane", "TailNum", "Part", value=listed("FlightCount", "Flights"),
             prepare=flights_text),
        view("manufacturer_totals", "Manufacturer", value=F.col("Total")),
        view("delay_histogram", "label", value=F.col("value")),
        view("delay_class_counts", "label", value=F.col("value")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
