"""Type coercion of text fields; bad values become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Form fields and the types they are read as.
CLASSIFY_FIELDS = {
    "DepDelay": "double", "Carrier": "string", "FlightDate": "string",
    "Dest": "string", "FlightNum": "string", "Origin": "string",
}
REGRESS_FIELDS = {**CLASSIFY_FIELDS, "DepDelay": "int"}


def coerce(text: Column, to: str) -> Column:
    return text.try_cast(to)


def coerce_fields(fields: dict[str, str]) -> list[Column]:
    """Projection that types every named field; a value that does not parse is null."""
    return [coerce(F.col(name), kind).alias(name) for name, kind in fields.items()]
