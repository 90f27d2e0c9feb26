"""Lookups, searches, listings and pages over flights, airplanes and results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylab.functions import clock
from delaylab.operators import hotkeys

# Page sizes and the search and sort fields of the two search forms.
FLIGHTS_PER_PAGE = 15
AIRPLANES_PER_PAGE = 5
FLIGHT_TERMS = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
FLIGHT_SORT = ["FlightDate", "DepTime", "Carrier", "FlightNum"]
AIRPLANE_TERMS = [
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
    "SerialNumber", "EngineManufacturer", "EngineModel",
]
AIRPLANE_SORT = ["Owner"]


def where_terms(df: DataFrame, terms: Mapping[str, str | None], allowed: list[str]) -> DataFrame:
    """Rows equal to every supplied term; absent and empty terms do not restrict."""
    unknown = set(terms) - set(allowed)
    if unknown:
        raise ValueError(f"not searchable: {sorted(unknown)}")
    given = [F.col(name) == value for name, value in terms.items() if value]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def _ascending(df: DataFrame, names: list[str]) -> list[Column]:
    """Ascending order with absent fields ignored and the other columns breaking ties."""
    present = [n for n in names if n in df.columns]
    rest = [n for n in df.columns if n not in present]
    return [F.col(n).asc_nulls_last() for n in present + rest]


def page(df: DataFrame, order: list[Column], start: int, size: int) -> DataFrame:
    """``size`` rows after skipping ``start``; planned as a top-k, not as a full sort.

    ``rank`` is the row's position in the whole listing. The window runs over one page.
    """
    cut = df.orderBy(*order).offset(start).limit(size)
    place = F.row_number().over(Window.orderBy(*order))
    return cut.withColumn("rank", (place + start).cast("long"))


def page_after(df: DataFrame, names: list[str], last: Mapping[str, object], size: int) -> DataFrame:
    """The page after the row ``last``: a filter plus a top-k at any depth of the listing.

    ``names`` must identify a row. Nulls come last, as in ``page``.
    """
    beyond = F.lit(False)
    for name in reversed(names):
        value = last[name]
        if value is None:
            beyond = F.col(name).isNull() & beyond
        else:
            more = (F.col(name) > F.lit(value)) | F.col(name).isNull()
            beyond = more | ((F.col(name) == F.lit(value)) & beyond)
    return df.where(beyond).orderBy(*[F.col(n).asc_nulls_last() for n in names]).limit(size)


def with_total(rows: DataFrame, hits: DataFrame, name: str = "total") -> DataFrame:
    """Add the number of all hits; a scalar subquery, so nothing is joined."""
    return rows.withColumn(name, hits.agg(F.count(F.lit(1))).scalar())


def search_flights(
    flights: DataFrame, terms: Mapping[str, str | None], start: int = 0,
    size: int = FLIGHTS_PER_PAGE,
) -> DataFrame:
    hits = where_terms(flights, terms, FLIGHT_TERMS)
    return with_total(page(hits, _ascending(hits, FLIGHT_SORT), start, size), hits)


def search_airplanes(
    airplanes: DataFrame, terms: Mapping[str, str | None], start: int = 0,
    size: int = AIRPLANES_PER_PAGE,
) -> DataFrame:
    hits = where_terms(airplanes, terms, AIRPLANE_TERMS)
    return with_total(page(hits, _ascending(hits, AIRPLANE_SORT), start, size), hits)


def navigation(bottom: Column, top: Column, step: int, total: Column) -> list[Column]:
    """Offsets of the next and previous page, and whether a link to each is shown."""
    columns = []
    for name, low, high in (
        ("next", bottom + step, top + step),
        ("previous", F.greatest(bottom - step, F.lit(0)), F.greatest(top - step, F.lit(0))),
    ):
        shown = (low >= 0) & (high > 0) & (total > low)
        columns += [
            low.alias(f"{name}_bottom"), high.alias(f"{name}_top"), shown.alias(f"{name}_link"),
        ]
    return columns


def flight_lookup(flights: DataFrame, carrier: str, flight_date: str, flight_num: str) -> DataFrame:
    """One flight by its key; of several matches always the same one."""
    matches = flights.where(
        (F.col("Carrier") == carrier) & (F.col("FlightDate") == flight_date)
        & (F.col("FlightNum") == flight_num)
    )
    return matches.orderBy(*_ascending(matches, ["DepTime", "ArrTime"])).limit(1)


def list_flights(flights: DataFrame, origin: str, dest: str, flight_date: str) -> DataFrame:
    """Flights of a route on a day in departure order, with their number."""
    day = flights.where(
        (F.col("Origin") == origin) & (F.col("Dest") == dest)
        & (F.col("FlightDate") == flight_date)
    )
    listed = day.orderBy(*_ascending(day, ["DepTime", "ArrTime"]))
    return with_total(listed, day, "flight_count")


def list_all_route_days(flights: DataFrame, limit: int = hotkeys.GROUP_ROWS) -> DataFrame:
    """``list_flights`` for every route and day at once, with each flight's place."""
    order = _ascending(flights.drop("Origin", "Dest", "FlightDate"), ["DepTime", "ArrTime"])
    return hotkeys.number_rows(
        flights, ["Origin", "Dest", "FlightDate"], order, "rank", "flight_count", limit
    )


def results_on_day(results: DataFrame, iso_date: str) -> DataFrame:
    """Results of one day; of a table stored by day only that day's folder is read."""
    if "request_date" in results.columns:
        results = results.where(F.col("request_date") == F.lit(iso_date).cast("date"))
    return results.where(clock.within_day(F.col("Timestamp"), iso_date))


def distance_topk(distances: DataFrame, k: int, longest: bool = True) -> DataFrame:
    """The ``k`` longest or shortest routes with their rank."""
    key = F.col("Distance").desc() if longest else F.col("Distance").asc()
    order = [key, F.col("Origin"), F.col("Dest")]
    place = F.row_number().over(Window.orderBy(*order))
    return distances.orderBy(*order).limit(k).withColumn("rank", place.cast("long"))


def carrier_list(fleet: DataFrame) -> DataFrame:
    """Carriers that have a fleet; a fleet split over several documents counts once."""
    return fleet.where(F.col("Part") == 0).select("Carrier")


def carriers(flights: DataFrame) -> DataFrame:
    """Carriers that have a fleet, without building it."""
    return flights.where(F.col("TailNum").isNotNull()).select("Carrier").distinct()


def monthly_listing(totals: DataFrame) -> DataFrame:
    """Monthly totals in calendar order. The window runs over as many rows as there are months."""
    place = F.row_number().over(Window.orderBy("Year", "Month"))
    return totals.withColumn("rank", place.cast("long"))


def ranked_manufacturers(totals: DataFrame, limit: int = hotkeys.GROUP_ROWS) -> DataFrame:
    """Manufacturer totals with their place by falling count."""
    return hotkeys.number_rows(
        totals, [], [F.col("Total").desc(), F.col("Manufacturer")], limit=limit
    )
