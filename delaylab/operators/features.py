"""From raw on-time records to the feature table, and request enrichment columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.functions import clock, text

# Columns that hold intermediate results of the model.
ML_COLUMNS = [
    "Features_vec", "rawPrediction", "probability", "indices", "values",
    "Carrier_index", "Origin_index", "Dest_index", "Route_index",
]

# Sort order of the feature table.
FEATURE_ORDER = [
    "DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime",
]


def project_features(flights: DataFrame) -> DataFrame:
    """The raw columns training needs; ``DayOfYear`` is still month-day text here."""
    return flights.select(
        "FlightNum", "FlightDate", "DayOfWeek",
        F.col("DayofMonth").alias("DayOfMonth"),
        F.concat(F.col("Month").cast("string"), F.lit("-"), F.col("DayofMonth").cast("string"))
        .alias("DayOfYear"),
        "Carrier", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay",
        "CRSDepTime", "CRSArrTime",
    )


def filter_complete(df: DataFrame) -> DataFrame:
    """Keep rows with both delays; the rest cannot be learned from."""
    return df.where(F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull())


def filter_incomplete(df: DataFrame) -> DataFrame:
    """The rows that :func:`filter_complete` drops."""
    return df.where(F.col("ArrDelay").isNull() | F.col("DepDelay").isNull())


def sample_share(df: DataFrame, share: float, seed: int) -> DataFrame:
    """Bernoulli sample of rows."""
    return df.sample(withReplacement=False, fraction=share, seed=seed)


def in_sample(keys: list[str], percent: float) -> Column:
    """Whether the MD5 of a row's key begins below ``percent`` of all; nulls count as absent.

    Any engine with MD5 draws the same rows, at every run and on every cluster.
    """
    if percent >= 100:
        return F.lit(True)
    bound = f"{round(percent * 0x100000000 / 100):08x}"
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text.cast("binary")), 1, 8) < bound


def sample_by_key(df: DataFrame, keys: list[str], percent: float) -> DataFrame:
    """Sample decided by the row's own key."""
    return df.where(in_sample(keys, percent))


def typed_features(df: DataFrame) -> DataFrame:
    """Projected rows as the feature table: timestamps, overnight arrivals, date parts.

    Dates and clocks are parsed in a step of their own, so that each is parsed once although
    the arrival uses both clocks several times.
    """
    parsed = df.withColumns({
        "FlightDate": F.col("FlightDate").try_cast("date"),
        "CRSDepTime": clock.hhmm_to_ts(F.col("FlightDate"), F.col("CRSDepTime")),
        "CRSArrTime": clock.hhmm_to_ts(F.col("FlightDate"), F.col("CRSArrTime")),
    })
    date = F.col("FlightDate")
    return parsed.select(
        F.col("ArrDelay").cast("double").alias("ArrDelay"),
        clock.overnight_arrival(F.col("CRSDepTime"), F.col("CRSArrTime")).alias("CRSArrTime"),
        "CRSDepTime",
        "Carrier",
        clock.day_of_month(date).alias("DayOfMonth"),
        clock.day_of_week(date).alias("DayOfWeek"),
        clock.day_of_year(date).alias("DayOfYear"),
        F.col("DepDelay").cast("double").alias("DepDelay"),
        "Dest",
        F.col("Distance").cast("double").alias("Distance"),
        "FlightDate",
        "FlightNum",
        "Origin",
    )


def extract_features(flights: DataFrame) -> DataFrame:
    """Project, filter and type in one narrow stage: no shuffle, no Python rows."""
    return flights.transform(project_features).transform(filter_complete).transform(typed_features)


def sort_features(features: DataFrame) -> DataFrame:
    """Total order by range partitioning; each written file covers one key range."""
    rest = [c for c in schemas.FEATURES.names if c not in FEATURE_ORDER]
    return features.orderBy(*FEATURE_ORDER, *rest)


def derive_route(df: DataFrame) -> DataFrame:
    return df.withColumn("Route", text.route(F.col("Origin"), F.col("Dest")))


def strip_ml_columns(df: DataFrame) -> DataFrame:
    """Drop what the model adds besides its prediction."""
    return df.drop(*ML_COLUMNS)


def with_date_parts(requests: DataFrame) -> DataFrame:
    """Calendar features of the flight date, computed as in training."""
    return requests.select("*", *clock.date_parts(F.col("FlightDate").try_cast("date")))


def flatten(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as columns."""
    return df.select(f"{column}.*")


def response_projection(scored: DataFrame) -> DataFrame:
    """Scored requests as rows of the response table, with the table's types."""
    return scored.select(
        F.col("UUID").alias("uuid"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        F.col("Carrier").alias("carrier"),
        F.col("FlightDate").cast("string").alias("flight_date"),
        F.col("DepDelay").alias("dep_delay"),
        F.col("Distance").alias("distance"),
        F.col("Prediction").cast("int").alias("prediction"),
        F.col("Timestamp").alias("timestamp"),
    )
