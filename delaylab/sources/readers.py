"""Sources: flights, features, requests, results, distances and message logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from delaylab import schemas
from delaylab.functions import clock
from delaylab.operators.hotkeys import latest_per_key
from delaylab.sources import versions


def read_flights(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """On-time records from Parquet, optionally registered for SQL."""
    flights = spark.read.parquet(path)
    if view:
        flights.createOrReplaceTempView(view)
    return flights


def read_features(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Feature table under its fixed schema. Gzip files of JSON lines are not split."""
    return spark.read.schema(schemas.FEATURES).format(format).load(path)


def read_requests_day(spark: SparkSession, path: str, iso_date: str) -> DataFrame:
    """One day of the request table; only that day's folder is listed and read."""
    schema = StructType([*schemas.REQUEST.fields, StructField("request_date", DateType())])
    table = spark.read.schema(schema).parquet(path)
    return table.where(F.col("request_date") == F.lit(iso_date).cast("date")).drop("request_date")


def requests_in_window(requests: DataFrame, iso_date: str) -> DataFrame:
    """Requests of one day by timestamp; the bounds are pushed into the scan."""
    return requests.where(clock.within_day(F.col("Timestamp"), iso_date))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Scored requests stored as JSON lines, typed while they are read."""
    return spark.read.schema(schemas.RESULT).json(path)


def ingest_distances(
    spark: SparkSession, paths: str | list[str], seen: Observation | None = None
) -> DataFrame:
    """Route distances from JSON lines; the last line of a route wins.

    Field names may be capitalised or not, blank lines and lines that are no JSON are skipped, absent names become ''
    and an absent distance 0; a distance that is no number is null. Line order is file path, split offset, then place in the scan.
    ``seen`` counts on the way: ``records``, ``blank`` lines, ``rejected`` lines that are no JSON,
    and ``failed_casts``, distances that are no number.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("_line"),
    )
    record = F.from_json("value", "map<string,string>")
    blank = F.trim("value") == ""
    parsed = lines.select(record.alias("r"), blank.alias("_blank"), "_line")

    def either(name: str, default: str):
        return F.coalesce(F.col("r")[name.capitalize()], F.col("r")[name], F.lit(default))

    written = either("distance", "0")
    typed = parsed.select(
        either("origin", "").alias("origin"),
        either("dest", "").alias("dest"),
        written.try_cast("double").alias("distance"),
        "_line", "_blank", F.col("r").isNull().alias("_none"),
    )
    if seen is not None:
        kept = ~F.col("_blank") & ~F.col("_none")
        typed = typed.observe(
            seen, F.count_if(kept).alias("records"), F.count_if("_blank").alias("blank"),
            F.count_if(F.col("_none") & ~F.col("_blank")).alias("rejected"),
            F.count_if(kept & F.col("distance").isNull()).alias("failed_casts"),
        )
    # A line that is no JSON is no record; it must not stand for the route of empty names.
    records = typed.where(~F.col("_blank") & ~F.col("_none")).drop("_blank", "_none")
    return latest_per_key(records, ["origin", "dest"], ["_line"]).drop("_line")


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """Current version of the distance table in the column names of flights and requests."""
    folder = versions.current(spark, path)
    return spark.read.schema(schemas.DISTANCES).parquet(folder).select(
        F.col("origin").alias("Origin"), F.col("dest").alias("Dest"),
        F.col("distance").alias("Distance"),
    )


#: Files whose first lines are read by one job.
HEADERS_AT_ONCE = 50


def _headers(spark: SparkSession, directory: str, pattern: str) -> dict[str, list[str]]:
    """Files of a directory by their first line; a job reads one line of each file."""
    # Listed by Spark: the contents are not among the columns and are not read.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    files = [r["path"] for r in listing.where("length > 0").select("path").orderBy("path").collect()]
    found: dict[str, list[str]] = {}
    for at in range(0, len(files), HEADERS_AT_ONCE):
        part = files[at : at + HEADERS_AT_ONCE]
        lines = [spark.read.text(f).limit(1).select(F.lit(f).alias("path"), "value") for f in part]
        for row in reduce(DataFrame.union, lines).collect():
            found.setdefault(row["value"], []).append(row["path"])
    return found


def _typed(raw: DataFrame) -> DataFrame:
    """The flight columns of ``raw`` by name, and how many of a row's values could not be cast."""
    named = {c.strip().lower(): c for c in reversed(raw.columns)}
    columns, failed = [], F.lit(0)
    for field in schemas.FLIGHTS:
        if field.name.lower() not in named:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{named[field.name.lower()]}`")
        cast = value.try_cast(field.dataType)
        columns.append(cast.alias(field.name))
        failed = failed + (value.isNotNull() & cast.isNull()).cast("int")
    return raw.select(*columns, failed.alias("_failed"))


def read_flight_files(
    spark: SparkSession, directory: str, format: str = "csv", seen: Observation | None = None
) -> DataFrame:
    """Every ``format`` file (csv, json or parquet) of a directory under the flight schema.

    Other files are left alone. CSV files are grouped by their header and each group is read by
    it: columns are taken by name, in any order and case; further columns are ignored, missing
    ones and values that cannot be cast are null. ``seen`` counts ``rows`` and ``failed_casts`` on
    the way. Files of other formats are read by schema and have no values to cast.
    """
    if format != "csv":
        reader = spark.read.format(format).option("pathGlobFilter", f"*.{format}")
        rows = reader.schema(schemas.FLIGHTS).load(directory).withColumn("_failed", F.lit(0))
    else:
        parts = [
            _typed(spark.read.option("header", "true").option("enforceSchema", "false").csv(files))
            for files in _headers(spark, directory, "*.csv").values()
        ]
        if not parts:
            parts = [spark.createDataFrame([], schemas.FLIGHTS).withColumn("_failed", F.lit(0))]
        rows = reduce(DataFrame.union, parts)
    if seen is not None:
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("_failed"), F.lit(0)).alias("failed_casts"),
        )
    return rows.drop("_failed")


def read_topic(spark: SparkSession, location: str) -> DataFrame:
    """What a topic kept as files holds now."""
    return spark.read.schema(schemas.TOPIC).parquet(location)


def stream_topic(
    spark: SparkSession, location: str, format: str = "parquet", **options: str
) -> DataFrame:
    """A message log as a stream with the columns of the Kafka source.

    ``format="kafka"`` subscribes to the topic ``location`` (the connector must be on the
    class path and ``kafka.bootstrap.servers`` among the options); a file format reads a
    folder into which message files arrive.
    """
    reader = spark.readStream.format(format).options(**options)
    if format == "kafka":
        return reader.option("subscribe", location).load()
    return reader.schema(schemas.TOPIC).load(location)
