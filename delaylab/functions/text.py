"""Text derived for display: routes, delay labels, shortened names, page links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class boundaries in minutes and the text shown for each class.
DELAY_SPLITS = [float("-inf"), -15.0, 0.0, 30.0, float("inf")]
DELAY_LABELS = [
    "Early (15+ Minutes Early)",
    "Slightly Early (0-15 Minute Early)",
    "Slightly Late (0-30 Minute Delay)",
    "Very Late (30+ Minutes Late)",
]


def route(origin: Column, dest: Column) -> Column:
    """``Origin-Dest``; null where either end is null."""
    return F.concat(origin, F.lit("-"), dest)


def delay_class(minutes: Column) -> Column:
    """Class of a delay as a plain expression; each class holds its lower bound."""
    return (
        F.when(minutes < DELAY_SPLITS[1], 0.0)
        .when(minutes < DELAY_SPLITS[2], 1.0)
        .when(minutes < DELAY_SPLITS[3], 2.0)
        .when(minutes.isNotNull(), 3.0)
    )


def delay_label(klass: Column) -> Column:
    """Text for a predicted class; null for an unknown class."""
    number = klass.cast("int")
    shown = F.when(number == 0, DELAY_LABELS[0])
    for position in range(1, len(DELAY_LABELS)):
        shown = shown.when(number == position, DELAY_LABELS[position])
    return shown


def truncate_label(text: Column, length: int = 14) -> Column:
    """Axis label: longer text keeps its first ``length`` characters and an ellipsis."""
    short = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, short).otherwise(text)


def strip_place(url: Column) -> Column:
    """URL without its paging parameters; any other URL is returned as it is."""
    return F.regexp_replace(url, r"^(.+)\?start=.+&end=.+$", "$1")
