"""Registered queries: a callable each, with an SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.operators import features, learning
from delaylab.plans import jobs, oracle
from delaylab.session import new_dir
from delaylab.sources import readers, testbed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: list[str] | None = None):
    """Register a query; ``views`` are the SQL views its counterpart reads."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(spark, sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = oracle.over(views or [], sql)
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and flags as numbers, so that both engines print them alike."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int").alias(field.name)
        shown.append(column)
    return df.select(*shown)


# Tables several queries start from, derived once per session and data folder.

_stored: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, what


def _once(spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], object]) -> str:
    key = _key(spark, sf_dir, what)
    if key not in _stored:
        path = new_dir(spark, what)
        write(path)
        _stored[key] = path
    return _stored[key]


def routed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends and distance of all flights.

    A feature table at hand has them for its flights; then only those it leaves out, which the
    filter picks before the joins, are derived.
    """
    names = ["Origin", "Dest", "Distance"]
    if _key(spark, sf_dir, "features") not in _stored:
        return testbed.flights(spark, sf_dir, *names)
    rest = features.filter_incomplete(testbed.flights(spark, sf_dir, *names, "DepDelay", "ArrDelay"))
    return stored_features(spark, sf_dir).select(*names).union(rest.select(*names))


def distances_path(spark: SparkSession, sf_dir: str) -> str:
    """Mean distance of every route. A query that needs the feature table too derives that first."""
    return _once(
        spark, sf_dir, "distances",
        lambda p: jobs.build_distances(routed_flights(spark, sf_dir), p),
    )


def stored_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_distances(spark, distances_path(spark, sf_dir))


def features_path(spark: SparkSession, sf_dir: str) -> str:
    """Unsorted feature table: training does not depend on row order."""
    def write(path: str) -> None:
        jobs.extract_features(testbed.flights(spark, sf_dir), path, ordered=False)

    return _once(spark, sf_dir, "features", write)


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_features(spark, features_path(spark, sf_dir))


def prepared_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.prepare_requests(
        testbed.requests(spark, sf_dir), stored_distances(spark, sf_dir)
    )


def model_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        learning.save_model(learning.train(stored_features(spark, sf_dir)), path)

    return _once(spark, sf_dir, "model", write)


def scorer(spark: SparkSession, sf_dir: str):
    return learning.load_model(model_path(spark, sf_dir))


def fleet_text(documents: DataFrame) -> DataFrame:
    return documents.withColumn("TailNumbers", F.array_join("TailNumbers", ";"))


def flights_text(documents: DataFrame) -> DataFrame:
    one = F.transform(
        "Flights",
        lambda f: F.concat_ws("|", f.Carrier, f.FlightDate, f.FlightNum, f.Origin, f.Dest),
    )
    return documents.withColumn("Flights", F.array_join(one, ";"))


