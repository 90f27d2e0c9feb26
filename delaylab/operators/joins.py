"""Joins between requests, distances, responses, airlines and fleets.

None of them carries a broadcast hint. Dimension tables are read from files, so Catalyst
knows their size and broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``;
above it the join is a shuffle join that adaptive execution splits where keys are hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylab.operators.hotkeys import first_per_key
from delaylab.session import materialize

#: Distinct lookup keys that are joined before flights are reduced; a few megabytes.
LOOKUP_KEYS = 50_000


def enrich_distance(requests: DataFrame, distances: DataFrame) -> DataFrame:
    """Distance of each request's route; 0 where unknown, with a flag that says so."""
    known = distances.select(
        F.col("Origin").alias("_o"), F.col("Dest").alias("_d"), F.col("Distance").alias("_known")
    )
    joined = requests.join(
        known, (requests["Origin"] == known["_o"]) & (requests["Dest"] == known["_d"]), "left"
    )
    return joined.select(
        *[requests[c] for c in requests.columns if c not in ("Distance", "distance_missing")],
        F.coalesce("_known", F.lit(0.0)).alias("Distance"),
        F.col("_known").isNull().alias("distance_missing"),
    )


def airline_profile(airlines: DataFrame, fleet: DataFrame) -> DataFrame:
    """Airline summary with its fleet; an airline without airplanes keeps its summary."""
    return airlines.join(
        fleet, airlines["CarrierCode"] == fleet["Carrier"], "left"
    ).drop("Carrier")


def response_status(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Per request ``OK`` and its prediction, or ``WAIT`` where no response exists.

    ``responses`` holds one row per uuid (see ``sources.upserts.read_latest``).
    """
    answered = responses.select(F.col("uuid").alias("_uuid"), F.col("prediction"))
    return requests.join(answered, requests["UUID"] == answered["_uuid"], "left").select(
        requests["UUID"].alias("id"),
        F.when(F.col("_uuid").isNotNull(), "OK").otherwise("WAIT").alias("status"),
        F.col("prediction"),
    )


def pending_requests(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests that no response has answered."""
    return requests.join(responses, requests["UUID"] == responses["uuid"], "left_anti")


def lookup_flights(keys: DataFrame, flights: DataFrame, few: int = LOOKUP_KEYS) -> DataFrame:
    """First flight of each requested (Carrier, FlightDate, FlightNum); many lookups, one job.

    Up to ``few`` distinct keys select their flights first, so that little is left to reduce.
    With more keys all flights are reduced first, to one of a key and task before the shuffle:
    neither repeated keys nor repeated flights pile up in one task. Both ways give the same rows;
    ``few`` decides the cost alone.
    """
    names = ["Carrier", "FlightDate", "FlightNum"]
    order = ["DepTime", "ArrTime", "Origin", "Dest", "TailNum"]
    wanted = materialize(keys.select(*names).distinct(), "lookup-keys")
    if wanted.count() <= few:
        return first_per_key(flights.join(wanted, names, "semi"), names, order)
    return wanted.join(first_per_key(flights, names, order), names, "inner")


def lookup_airplanes(keys: DataFrame, documents: DataFrame) -> DataFrame:
    """Flight documents of each requested tail number."""
    return keys.select("TailNum").distinct().join(documents, ["TailNum"], "left")
