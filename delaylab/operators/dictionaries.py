"""Category dictionaries as tables: labels numbered by falling frequency.

A dictionary is built by a partial aggregate and a numbering that no label can make uneven, and
it stays a table: only one that is known to be short, by an exact count, is turned into a model
on the driver. Rows are encoded by joins. As numbers fall with frequency, the first ``HEAD``
labels of a column hold every label that more than a 1/``HEAD`` part of the rows has; they are
broadcast. What is left has no hot label and is joined by shuffle.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylab.operators import aggregates
from delaylab.session import materialize

#: Labels of a column that are broadcast to encode rows.
HEAD = 1000


def build(df: DataFrame, columns: list[str]) -> DataFrame:
    """The stored dictionary of ``columns``: column_name, label, n and idx (0 is the most frequent)."""
    return materialize(aggregates.index_labels(df, columns), "dictionary")


def sizes(dictionary: DataFrame, columns: list[str]) -> dict[str, int]:
    """Exact number of labels of each column."""
    counted = dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["column_name"]: r["n"] for r in counted}
    return {c: found.get(c, 0) for c in columns}


def encode(df: DataFrame, dictionary: DataFrame, columns: list[str], head: int = HEAD) -> DataFrame:
    """Add ``{column}_index``; a null or a label that is not in the dictionary gets the next index.

    A dictionary of any size will do. Rows whose label is among the first ``head`` are dealt out
    evenly in the join with the rest, so a hot label does not gather them.
    """
    known = sizes(dictionary, columns)
    for c in columns:
        own = dictionary.where(F.col("column_name") == c)
        first = own.where(F.col("idx") < head).select(
            F.col("label").alias("_label"), F.col("idx").alias("_idx")
        )
        df = df.join(F.broadcast(first), df[c] == F.col("_label"), "left").drop("_label")
        index = F.col("_idx")
        if known[c] > head:
            rest = own.where(F.col("idx") >= head).select(
                F.lit(True).alias("_open"), F.col("label").alias("_key"), F.col("idx").alias("_late")
            )
            open_ = F.col("_idx").isNull() & F.col(c).isNotNull()
            spread = F.monotonically_increasing_id().cast("string")
            df = df.withColumns({
                "_open": open_, "_key": F.when(open_, F.col(c).cast("string")).otherwise(spread),
            })
            df = df.join(rest, ["_open", "_key"], "left").drop("_open", "_key")
            index = F.coalesce("_idx", "_late")
        df = df.withColumn(f"{c}_index", F.coalesce(index, F.lit(float(known[c])))).drop("_idx", "_late")
    return df


def indexers(dictionary: DataFrame, columns: list[str], limit: int) -> list[StringIndexerModel]:
    """The dictionary as a fitted model for each column; none may have more than ``limit`` labels.

    The models live on the driver and in every task; a longer dictionary is refused.
    """
    for c, n in sizes(dictionary, columns).items():
        if n > limit:
            raise ValueError(f"{c} has {n} values, over {limit}: encode it as \"hashed\"")
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in dictionary.where(F.col("column_name").isin(columns)).orderBy("column_name", "idx").collect():
        labels[row["column_name"]].append(row["label"])
    # One model per column: lists of different lengths in one model are filled up with nulls.
    return [
        StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
        for c in columns
    ]
