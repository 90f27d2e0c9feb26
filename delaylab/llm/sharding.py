"""Contiguous shards of near-equal byte size.

The rows are sorted by range. Each sorted partition counts its rows and bytes as they pass by;
the totals of the partitions, one row each, are summed to global prefix sums. A row goes to the
shard in whose equal share of all bytes its middle byte lies. Neither a partition nor a shard is
ever gathered, and the rows that travel are narrow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.scratch import stored as materialize

_PLACES = ("_part", "_rows_before", "_bytes_before")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the rows and bytes of the partition before each row."""
    part, rows, size = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        n = batch.num_rows
        sizes = batch.column(batch.schema.get_field_index("size")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        added = [
            pa.array(np.full(n, part, np.int64)),
            pa.array(np.arange(rows, rows + n, dtype=np.int64)),
            pa.array(size + ends - sizes),
        ]
        yield pa.RecordBatch.from_arrays(
            batch.columns + added, names=batch.schema.names + list(_PLACES)
        )
        if n:
            rows, size = rows + n, size + int(ends[-1])


def text_size(text: Column, overhead: int = 8) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed cost per row."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(overhead)).cast("long")


def balanced_shards(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 within its shard).

    ``rows`` needs a column ``size`` (long, not negative; null counts as 0). Shards are
    contiguous in the order of ``key``: every row of a shard sorts before those of the next one.
    A shard's bytes differ from an equal share by less than the largest row. Null keys come
    first; rows with equal keys, repeated rows too, are told apart by their place in the input
    and may be cut between shards, so no key is too frequent. An empty table gives an empty
    one. Columns named ``shard`` or ``slot`` (any case) are replaced. ``rows`` should come from
    files: the place of a row must be the same whenever it is read.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    taken = {"shard", "slot", "size", *_PLACES, "_row"}
    kept = [c for c in rows.columns if c.lower() not in taken]
    numbered = rows.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"),
    ).withColumn("_row", F.monotonically_increasing_id())
    schema = T.StructType(numbered.schema.fields)
    for name in _PLACES:
        schema = schema.add(name, "long")
    placed = materialize(
        numbered.repartitionByRange(F.col(f"`{key}`"), "_row")
        .sortWithinPartitions(F.col(f"`{key}`"), "_row")
        .mapInArrow(_running, schema),
        "shard-places",
    )
    # One row per partition from here on, until the sums are joined back.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(
        F.count("*").alias("_rows"), F.sum("size").alias("_bytes")
    )
    sums = materialize(
        totals.select(
            "_part",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_part_rows"),
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_part_bytes"),
            (F.coalesce(F.sum("_bytes").over(before), F.lit(0)) + F.col("_bytes")).alias("_upto"),
        ),
        "shard-sums",
    )
    total = sums.agg(F.max("_upto")).first()[0] or 1
    middle = 2 * (F.col("_part_bytes") + F.col("_bytes_before")) + F.col("size")
    share = F.floor((middle / F.lit(2.0 * total)) * shards).cast("int")
    cut = placed.join(sums, "_part").select(
        *(F.col(f"`{c}`") for c in [*kept, "size"]),
        F.greatest(F.lit(0), F.least(F.lit(shards - 1), share)).alias("shard"),
        (F.col("_part_rows") + F.col("_rows_before")).alias("_place"),
    )
    firsts = materialize(
        cut.groupBy("shard").agg(F.min("_place").alias("_first")), "shard-firsts"
    )
    return cut.join(firsts, "shard").select(
        *(F.col(f"`{c}`") for c in [*kept, "size"]),
        "shard",
        (F.col("_place") - F.col("_first")).alias("slot"),
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards near equal in bytes, contiguous by document number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", text_size(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32")
    )
    return balanced_shards(rows, "doc_id", 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The checksum is formed byte by byte with the usual table of 256 steps.
_SQL = """
WITH steps AS (
  SELECT n, list_reduce([CAST(n AS BIGINT), 0, 1, 2, 3, 4, 5, 6, 7],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(n)),
tbl AS (SELECT list(v ORDER BY n) AS t FROM steps),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
h AS (SELECT doc_id, octet_length(x) + 8 AS size,
    list_transform(regexp_extract_all(hex(x), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS b FROM d),
e AS (SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(4294967295, list_reduce(list_prepend(4294967295, b),
    lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1]))) AS BIGINT) AS text_crc32 FROM h, tbl),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM e),
s AS (SELECT doc_id, size, text_crc32, greatest(0, least(23,
    CAST(floor((CAST(2 * before + size AS DOUBLE) / (2.0 * total)) * 24) AS INT))) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM s
"""

QUERIES = {"op1_sharding": op1_sharding}
ORACLE = {"op1_sharding": _SQL}
