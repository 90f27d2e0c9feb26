"""Sinks: feature files, daily partitions, appended results, message files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from delaylab.sources import versions

#: Upper bound of rows per output file.
FILE_ROWS = 5_000_000
#: Upper bound of rows in a file of compressed lines, which one task reads whole (some 10 MB).
LINES_ROWS = 500_000


def write_features(features: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace the feature table, one file per task and never a single one.

    ``json`` gives gzip-compressed lines. Such a file is not split, so it holds few rows, and a
    scan has as many tasks as there are files.
    """
    writer = features.write.mode("overwrite")
    if format == "json":
        writer = writer.option("compression", "gzip").option("ignoreNullFields", "true")
    rows = LINES_ROWS if format == "json" else FILE_ROWS
    writer.option("maxRecordsPerFile", rows).format(format).save(path)


def write_distances(distances: DataFrame, path: str) -> None:
    """Publish a new version of the distance table; who reads the one before is not disturbed."""
    table = distances.select(
        F.col("Origin").alias("origin"), F.col("Dest").alias("dest"),
        F.col("Distance").alias("distance"),
    )
    versions.publish(distances.sparkSession, path, lambda folder: table.write.parquet(folder))


def write_daily(
    df: DataFrame, path: str, moment: str = "Timestamp", rebalance: bool = True,
    day: str | None = None,
) -> int:
    """Replace exactly the days present in ``df``; other days stay as they are.

    With ``day`` (yyyy-mm-dd) that day alone is replaced by its rows in ``df``, and emptied if it
    has none; without it a day that ``df`` does not mention keeps its rows. Returns how many rows
    were left out because they are of another day or have no time; without ``day`` none are.

    Rows are rebalanced by day: adaptive execution joins small days and splits a large one,
    so a day is neither one huge file nor one sliver per task. Rows that already come from
    well-sized files of one day need no such shuffle (``rebalance=False``). Running a day
    again gives the same table.
    """
    if day is not None:
        theirs = F.to_date(moment) == F.lit(day).cast("date")
        seen = Observation()
        counted = df.observe(seen, F.count_if(~F.coalesce(theirs, F.lit(False))).alias("left_out"))
        counted.where(theirs).write.mode("overwrite").option(
            "maxRecordsPerFile", FILE_ROWS
        ).parquet(f"{path}/request_date={day}")
        return seen.get["left_out"]
    dated = df.withColumn("request_date", F.to_date(moment))
    (
        (dated.hint("rebalance", "request_date") if rebalance else dated)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy("request_date").parquet(path)
    )
    return 0


def append_results(results: DataFrame, path: str, format: str = "parquet") -> None:
    """Add results to the serving store."""
    results.write.mode("append").format(format).save(path)


def write_results_lines(results: DataFrame, path: str) -> None:
    """Scored requests as JSON lines."""
    results.write.mode("overwrite").option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(path)


def write_flights_csv(flights: DataFrame, path: str) -> None:
    flights.write.mode("overwrite").option("header", "true").csv(path)


def land_flights(flights: DataFrame, path: str) -> None:
    """Put ingested flights into the lake as Parquet."""
    flights.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
