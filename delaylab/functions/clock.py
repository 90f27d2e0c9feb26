"""Clock strings, overnight arrivals, calendar parts and day windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_to_ts(date: Column, hhmm: Column) -> Column:
    """Wall-clock timestamp of an ISO ``date`` and an ``HHMM`` clock string.

    Hour 24 means the last minute of the day. Short strings are padded ("5" is 00:05);
    anything that is not a clock gives null instead of failing the job.
    """
    padded = F.lpad(F.trim(hhmm), 4, "0")
    hour = F.substring(padded, 1, 2)
    minute = F.substring(padded, 3, 2)
    clock = F.when(hour == "24", F.lit("23:59")).otherwise(F.concat_ws(":", hour, minute))
    text = F.concat_ws(" ", date.cast("string"), clock)
    valid = F.length(F.trim(hhmm)).between(1, 4) & date.isNotNull()
    return F.when(valid, text.try_cast("timestamp_ntz"))


def overnight_arrival(departure: Column, arrival: Column) -> Column:
    """Arrival moved to the next day where it would lie before the departure."""
    return F.when(arrival < departure, arrival + F.expr("INTERVAL 1 DAY")).otherwise(arrival)


def day_of_year(date: Column) -> Column:
    return F.dayofyear(date)


def day_of_month(date: Column) -> Column:
    return F.dayofmonth(date)


def day_of_week(date: Column) -> Column:
    """Monday is 0 and Sunday is 6, for training and scoring alike."""
    return F.weekday(date)


def date_parts(date: Column) -> list[Column]:
    """The three calendar features of a date."""
    return [
        day_of_year(date).alias("DayOfYear"),
        day_of_month(date).alias("DayOfMonth"),
        day_of_week(date).alias("DayOfWeek"),
    ]


def day_window(moment: Column) -> tuple[Column, Column]:
    """First day and the day after of the half-open day holding ``moment``."""
    day = F.to_date(moment)
    return day, F.date_add(day, 1)


def within_day(moment: Column, iso_date: str) -> Column:
    """Range predicate for one day; bounds are literals so that it reaches the scan."""
    start = F.lit(iso_date).cast("timestamp_ntz")
    end = F.date_add(F.lit(iso_date).cast("date"), 1).cast("timestamp_ntz")
    return (moment >= start) & (moment < end)
