"""End-to-end jobs as functions of a session and paths; each may be run again safely."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaylab.operators import aggregates, features, joins, learning
from delaylab.operators.learning import ForestSettings
from delaylab.sources import readers, versions, writers
from delaylab.streaming import sinks, topics


def extract_features(
    flights: DataFrame, path: str, share: float | None = None, seed: int = 27,
    format: str = "parquet", ordered: bool = True,
) -> None:
    """Flights to the feature table, optionally from a sample of the flights.

    ``ordered`` sorts the table, which costs a shuffle; training does not need it.
    """
    source = flights if share is None else features.sample_share(flights, share, seed)
    table = features.extract_features(source)
    writers.write_features(features.sort_features(table) if ordered else table, path, format)


def land_distances(spark: SparkSession, lines: str | list[str], path: str) -> dict[str, int]:
    """Lines of distances to a new version of the distance table; how many were taken and not."""
    seen = Observation()
    table = readers.ingest_distances(spark, lines, seen).select(
        F.col("origin").alias("Origin"), F.col("dest").alias("Dest"), F.col("distance").alias("Distance")
    )
    writers.write_distances(table, path)
    return seen.get


def land_flights(
    spark: SparkSession, directory: str, path: str, format: str = "csv"
) -> dict[str, int]:
    """Flight files of a directory to the lake; rows, and values that could not be cast."""
    seen = Observation()
    writers.land_flights(readers.read_flight_files(spark, directory, format, seen), path)
    return seen.get


def build_distances(flights: DataFrame, path: str) -> None:
    """Mean distance of every route to the distance table."""
    writers.write_distances(aggregates.origin_dest_distances(flights), path)


def train(
    spark: SparkSession, features_path: str, model_path: str, runs_path: str,
    settings: ForestSettings = ForestSettings(), format: str = "parquet",
    encoding: dict[str, str] | None = None, partitions: int | None = None,
) -> float:
    """Feature table to a stored model and a row in the run table; returns the accuracy.

    ``encoding`` names the categories that are hashed, ``partitions`` how many parts the rows
    are dealt to; see ``learning.train``.
    """
    table = readers.read_features(spark, features_path, format)
    profile = learning.profile_training(table)
    if profile.nulls.get("ArrDelay") or profile.nulls.get("DepDelay"):
        table = features.filter_complete(table)
    partitions = partitions or learning.default_partitions(table)
    model = learning.train(table, settings, encoding, partitions=partitions)
    learning.save_model(model, model_path)
    quality = learning.evaluate_in_sample(table, model)
    learning.log_run(spark, runs_path, model, profile.rows, quality, encoding, partitions)
    return quality


def prepare_requests(requests: DataFrame, distances: DataFrame) -> DataFrame:
    """Bare requests with distance and calendar features, as scoring expects them."""
    return features.with_date_parts(joins.enrich_distance(requests, distances)).drop(
        "distance_missing"
    )


def _whole_day(left_out: int, iso_date: str) -> None:
    if left_out:
        raise RuntimeError(f"{left_out} rows are not of {iso_date}")


def fetch_requests(requests: DataFrame, iso_date: str, path: str) -> None:
    """One day of the request store to its daily folder."""
    window = readers.requests_in_window(requests, iso_date)
    _whole_day(writers.write_daily(window, path, day=iso_date), iso_date)


def score_day(spark: SparkSession, iso_date: str, tasks_path: str, model_path: str,
              results_path: str) -> None:
    """Score one day of requests and replace that day's results."""
    tasks = readers.read_requests_day(spark, tasks_path, iso_date)
    scored = learning.score(tasks, learning.load_model(model_path))
    _whole_day(writers.write_daily(scored, results_path, day=iso_date), iso_date)


def daily_score(spark: SparkSession, requests: DataFrame, iso_date: str, tasks_path: str,
                model_path: str, results_path: str) -> None:
    """Fetch, score and store one day; running the day again gives the same tables."""
    fetch_requests(requests, iso_date, tasks_path)
    score_day(spark, iso_date, tasks_path, model_path, results_path)


def score_batches(model_path: str, distances_path: str) -> sinks.Prepare:
    """Enrich and score each micro-batch with the distances and the model that are current then.

    A version is resolved once per batch and read to its end; a model that has not changed is
    not loaded again. Requests that came with a distance keep it.
    """
    loaded: dict[str, PipelineModel] = {}

    def prepare(batch: DataFrame, batch_id: int, run: str) -> DataFrame:
        spark = batch.sparkSession
        version = versions.current(spark, model_path)
        if version not in loaded:
            loaded.clear()
            loaded[version] = learning.load_version(version)
        sent = batch.withColumnRenamed("Distance", "_sent")
        distances = readers.read_distances(spark, distances_path)
        complete = joins.enrich_distance(sent, distances).withColumn(
            "Distance", F.coalesce("_sent", "Distance")
        ).drop("_sent", "distance_missing")
        return learning.score(complete, loaded[version])

    return prepare


def stream_score(
    log: DataFrame, model_path: str, distances_path: str, targets: dict[str, sinks.BatchSink],
    checkpoint: str, every: str | None = None, duplicates_within: str | None = None,
    seen_path: str | None = None,
) -> StreamingQuery:
    """Request topic to all sinks. Requests that came without a distance are given one.

    Distances and model may be rebuilt while the stream runs; each batch takes what is current.
    ``duplicates_within`` drops repeated messages that arrive within that delay, and rows later
    than that. ``seen_path`` drops every repetition of an identifier, whenever it comes, and
    nothing else but messages without one. Without both, repeated messages are scored again and
    the response table keeps the last.
    """
    if duplicates_within:
        parsed = topics.parse_once(log, duplicates_within)
    else:
        parsed = topics.parse_requests(log)
    score = score_batches(model_path, distances_path)
    if seen_path is None:
        return sinks.fan_out(parsed, targets, checkpoint, every, score)
    first = sinks.first_seen(seen_path)

    def prepare(batch: DataFrame, batch_id: int, run: str) -> DataFrame:
        return score(first(batch, batch_id, run), batch_id, run)

    every_sink = {**targets, "seen": sinks.remembered(seen_path)}
    return sinks.fan_out(parsed, every_sink, checkpoint, every, prepare)


def build_serving_views(flights: DataFrame, airplanes: DataFrame, path: str) -> list[str]:
    """Every aggregate the dashboard serves, one table each below ``path``.

    Four of them come from a single scan of the flights.
    """
    rollup = aggregates.FlightRollup(flights)
    views = {
        "flights_by_month": rollup.flights_by_month(),
        "airplanes_per_carrier": rollup.airplanes_per_carrier(),
        "flights_per_airplane": aggregates.flights_per_airplane(flights),
        "manufacturer_totals": aggregates.manufacturer_totals(airplanes),
        "delay_histogram": rollup.delay_histogram(),
        "delay_class_counts": rollup.delay_class_counts(),
    }
    for name, view in views.items():
        view.write.mode("overwrite").parquet(f"{path}/{name}")
    return list(views)
