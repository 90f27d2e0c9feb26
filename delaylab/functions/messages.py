"""Request and response messages as JSON text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylab import schemas

# Fixed value: an ISO timestamp with microseconds.
_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: Keys of a request message.
REQUEST_FIELDS = [
    "DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin", "Distance",
    "DayOfYear", "DayOfMonth", "DayOfWeek", "Timestamp", "UUID",
]


def _json(columns: list[Column]) -> Column:
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": _ISO_MICROS})


def request_message() -> Column:
    """A request row as the JSON text that goes onto the request topic."""
    return _json([F.col(name) for name in REQUEST_FIELDS])


def name_uuid(name: Column) -> Column:
    """Name-based UUID (version 3: MD5) of a text, as text; equal names give equal identifiers."""
    digest = F.md5(name.cast("binary"))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 8))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
        F.concat(F.lit("3"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def stamp_request(
    df: DataFrame, batch: str, number: str | None = None, at: datetime | None = None
) -> DataFrame:
    """Give new requests an identifier and a time, as the entry point does.

    The identifier follows from the name of the batch and the row's ``number``, a column that is
    unique in the batch, so a task or a job that runs again gives the same ones. Without
    ``number`` the place in the scan is taken; ``df`` must be read straight from files then. ``at``
    is the batch's time, by default the start of the job.
    """
    row = F.monotonically_increasing_id() if number is None else F.col(number)
    moment = F.current_timestamp() if at is None else F.lit(at)
    name = F.concat_ws("/", F.lit(batch), row.cast("string"))
    return df.withColumns({"UUID": name_uuid(name), "Timestamp": moment.cast("timestamp_ntz")})


def response_message() -> Column:
    """A scored request as the JSON text that goes onto the response topic."""
    return _json([
        F.col("UUID"), F.col("Origin"), F.col("Dest"), F.col("Carrier"), F.col("FlightDate"),
        F.col("DepDelay"), F.col("Distance"), F.col("Prediction").alias("prediction"),
        F.col("Timestamp"),
    ])


def parse(value: Column, schema) -> Column:
    """Typed struct of JSON text or bytes; malformed text gives a struct of nulls."""
    return F.from_json(value.cast("string"), schema)


def parse_request(value: Column) -> Column:
    return parse(value, schemas.REQUEST)


def parse_response(value: Column) -> Column:
    return parse(value, schemas.RESPONSE_MESSAGE)
