"""Sorted listings kept in blocks, so that a page at any depth reads the block it lies in.

The rows are sorted by range over the cluster and numbered once. They are stored in folders of
equally many rows, sorted inside, with a sparse index beside them: the first key and the number of
rows of every block. A page is a range of numbers: its folder follows from the number, and within
the folder the numbers' minima and maxima leave few row groups to read.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.operators import hotkeys
from delaylab.session import materialize

#: Rows of a block.
BLOCK_ROWS = 1_000_000
#: Blocks of a listing at most; each is a folder that every reader has to list.
BLOCKS = 256


def _order(df: DataFrame, names: list[str]) -> list[Column]:
    """``names`` ascending with nulls last; the other columns break ties."""
    rest = [c for c in df.columns if c not in names]
    return [F.col(n).asc_nulls_last() for n in [*names, *rest]]


def store_listing(df: DataFrame, names: list[str], path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Store ``df`` in the order of ``names`` as a listing below ``path``, replacing the one there.

    Adds ``rank``, the place from 1. ``rank`` and ``block`` are names of the listing's own. A long
    listing has a multiple of ``block_rows`` in each block, so that there are ``BLOCKS`` at most.
    """
    spark = df.sparkSession
    source = materialize(df, "unlisted")
    block_rows *= max(1, ceil(source.count() / (block_rows * BLOCKS)))
    ranked = hotkeys.number_rows(source, [], _order(df, names), stored=True)
    block = F.floor((F.col("rank") - 1) / block_rows)
    (
        ranked.withColumn("block", block).hint("rebalance", "block").sortWithinPartitions("block", "rank")
        .write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows")
    )
    schema = T.StructType([*ranked.schema.fields, T.StructField("block", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    # Numbers are compared, so this is a hash aggregate; the keys come from one row of each block.
    sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.min("rank").alias("rank"))
    firsts = rows.where((F.col("rank") - 1) % block_rows == 0).select("rank", *names)
    index = sizes.join(firsts, "rank").withColumn("block_rows", F.lit(block_rows))
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per block: its number, first rank, rows and first key."""
    return spark.read.parquet(f"{path}/index")


def total(spark: SparkSession, path: str) -> int:
    """Rows of the listing, from the index alone."""
    return read_index(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_page(spark: SparkSession, path: str, start: int, size: int) -> DataFrame:
    """``size`` rows after skipping ``start``, with their rank and the listing's ``total``.

    Of a listing without rows there is no page: see :func:`total`.
    """
    index = read_index(spark, path)
    meta = index.agg(F.max("block_rows").alias("b"), F.sum("rows").alias("n")).first()
    if meta["b"] is None:
        raise LookupError(f"the listing at {path} is empty")
    rows = spark.read.parquet(f"{path}/rows")
    low, high = start // meta["b"], max(start, start + size - 1) // meta["b"]
    return (
        rows.where(F.col("block").between(low, high))
        .where((F.col("rank") > start) & (F.col("rank") <= start + size))
        .drop("block").withColumn("total", F.lit(meta["n"]).cast("long"))
    )


def rank_of(spark: SparkSession, path: str, names: list[str], key: Mapping[str, object]) -> int:
    """How many rows of the listing stand before ``key``; one block is read.

    ``names`` are those the listing was stored by. A page that begins at a key starts there.
    """
    before = F.lit(False)
    for name in reversed(names):
        value = key[name]
        if value is None:  # nulls come last
            before = F.col(name).isNotNull() | (F.col(name).isNull() & before)
        else:
            before = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & before)
    # Of the blocks that begin before the key only the last may also hold rows behind it.
    last = read_index(spark, path).where(F.coalesce(before, F.lit(False))).agg(
        F.max_by("block", "rank").alias("block"), F.max("rank").alias("rank")
    ).first()
    if last["block"] is None:
        return 0
    block = spark.read.parquet(f"{path}/rows").where(F.col("block") == last["block"])
    return last["rank"] - 1 + block.where(F.coalesce(before, F.lit(False))).count()
