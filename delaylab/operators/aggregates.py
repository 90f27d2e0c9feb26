"""Aggregates over flights, airplanes, features, predictions and message logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylab.functions import text
from delaylab.operators import hotkeys
from delaylab.session import materialize

#: Array entries one serving document may hold.
DOCUMENT_ITEMS = 10_000


def origin_dest_distances(flights: DataFrame) -> DataFrame:
    """Mean distance of every route."""
    return flights.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with their counts, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        counts.unpivot([], list(df.columns), "column_name", "null_count")
        .where(F.col("null_count") > 0)
    )


def prediction_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("Prediction").agg(F.count(F.lit(1)).alias("count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table; a table without rows counts zero."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def flights_by_month(flights: DataFrame) -> DataFrame:
    return flights.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("total_flights"))


def fleet_documents(pairs: DataFrame, limit: int = DOCUMENT_ITEMS) -> DataFrame:
    """Tail numbers of every carrier as sorted arrays, from stored distinct (Carrier, TailNum)."""
    return hotkeys.nest(pairs, ["Carrier"], ["TailNum"], "TailNumbers", "FleetCount", limit)


def airplanes_per_carrier(flights: DataFrame, limit: int = DOCUMENT_ITEMS) -> DataFrame:
    """Distinct tail numbers of every carrier as sorted arrays, with the fleet size."""
    pairs = flights.select("Carrier", "TailNum").where(F.col("TailNum").isNotNull()).distinct()
    return fleet_documents(materialize(pairs, "fleet-pairs"), limit)


def flights_per_airplane(flights: DataFrame, limit: int = DOCUMENT_ITEMS) -> DataFrame:
    """Flights of every airplane as arrays of (carrier, date, number, origin, destination)."""
    fields = ["Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
    return hotkeys.nest(flights, ["TailNum"], fields, "Flights", "FlightCount", limit)


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    return airplanes.groupBy("Manufacturer").agg(F.count(F.lit(1)).alias("Total"))


def _bin(column: str, width: int) -> Column:
    return (F.floor(F.col(column) / width) * width).cast("int")


def delay_histogram(flights: DataFrame, width: int = 15, column: str = "ArrDelay") -> DataFrame:
    """Flights per delay bin of ``width`` minutes, labelled by the bin's lower bound."""
    return (
        flights.where(F.col(column).isNotNull())
        .groupBy(_bin(column, width).alias("label")).agg(F.count(F.lit(1)).alias("value"))
    )


def _labelled(counts: DataFrame) -> DataFrame:
    return counts.select(text.delay_label(F.col("klass")).alias("label"), "value")


def delay_class_counts(flights: DataFrame, column: str = "ArrDelay") -> DataFrame:
    """Flights per delay class, with the class's display text."""
    klass = text.delay_class(F.col(column))
    return _labelled(
        flights.where(F.col(column).isNotNull())
        .groupBy(klass.alias("klass")).agg(F.count(F.lit(1)).alias("value"))
    )


class FlightRollup:
    """Four views of flights from one scan, by grouping sets that are counted together.

    Every task reduces its rows to one per month, per airplane of a carrier, and per delay bin
    and class, before anything is shuffled. Bins lie within classes or are counted per class, so
    the classes are sums of the histogram's rows.
    """

    def __init__(self, flights: DataFrame, width: int = 15, column: str = "ArrDelay"):
        names = ["Year", "Month", "Carrier", "TailNum", "label", "klass"]
        rows = flights.select(
            *names[:4], _bin(column, width).alias("label"), text.delay_class(F.col(column)).alias("klass")
        )
        sets = [names[:2], names[2:4], names[4:]]
        counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(
            F.count(F.lit(1)).alias("n"), F.grouping_id().alias("of")
        )
        self._counts = materialize(counted, "flight-rollup")
        # A column that a set does not group by is a one in its number, the first one highest.
        self._of = [int("".join("01"[c not in s] for c in names), 2) for s in sets]

    def _set(self, number: int) -> DataFrame:
        return self._counts.where(F.col("of") == self._of[number])

    def flights_by_month(self) -> DataFrame:
        return self._set(0).select("Year", "Month", F.col("n").alias("total_flights"))

    def airplanes_per_carrier(self, limit: int = DOCUMENT_ITEMS) -> DataFrame:
        pairs = self._set(1).where(F.col("TailNum").isNotNull()).select("Carrier", "TailNum")
        return fleet_documents(pairs, limit)

    def delay_histogram(self) -> DataFrame:
        known = self._set(2).where(F.col("label").isNotNull())
        return known.groupBy("label").agg(F.sum("n").alias("value"))

    def delay_class_counts(self) -> DataFrame:
        known = self._set(2).where(F.col("klass").isNotNull())
        return _labelled(known.groupBy("klass").agg(F.sum("n").alias("value")))


def classification_accuracy(scored: DataFrame, prediction: Column, label: Column) -> DataFrame:
    """Share of rows whose prediction equals their label."""
    return scored.agg(F.avg((prediction == label).cast("double")).alias("accuracy"))


def index_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Category dictionaries: per column, labels numbered by falling frequency, then by name.

    All columns are counted in one pass; only distinct labels are shuffled.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("label")) for c in columns
    ])
    counts = (
        df.select(F.explode(pairs).alias("pair")).select("pair.*")
        .where(F.col("label").isNotNull())
        .groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("n"))
    )
    numbered = hotkeys.number_rows(
        materialize(counts, "label-counts"), ["column_name"], [F.col("n").desc(), F.col("label")], "place"
    )
    return numbered.select(
        "column_name", "label", "n", (F.col("place") - 1).cast("double").alias("idx")
    )


def topic_offsets(log: DataFrame) -> DataFrame:
    """Messages and next offset of every topic partition."""
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"), (F.max("offset") + 1).alias("next_offset")
    )


def distinct_routes(flights: DataFrame) -> DataFrame:
    return flights.select("Origin", "Dest").distinct()
