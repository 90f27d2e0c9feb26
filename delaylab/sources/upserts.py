"""A keyed table on plain files: append versions by batch, pick the last one on read.

Rewriting a table for every micro-batch costs its whole size. Here a batch writes only its
own rows into its own folder, replaced as a whole if the batch is replayed, and readers take
the last version per key. ``compact`` folds the versions together.

Folders are named by run and batch. Batch numbers begin anew with every checkpoint, so several
queries, or one with a new checkpoint, can share a table only because each has a run of its own.
Inside a batch, rows lie in folders by a hash of their key, in files with a Bloom filter on the
key: one key is looked up in one folder of each batch, and few of their row groups are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from delaylab import schemas
from delaylab.operators.hotkeys import latest_per_key

RUN, BATCH, BUCKET = "run", "batch", "bucket"
#: The run of what no query wrote. It sorts before the runs of queries, which begin with a time.
NO_RUN = "0"
#: Folders by key hash. Fixed for the life of a table. A batch writes a file or more to each that
#: it has keys of; a lookup reads one.
BUCKETS = 16
#: A compacted table begins with this batch, older than any other.
_BASE = -1
#: What orders the versions of a response before run and batch do.
MOMENT = ["timestamp"]


def bucket_of(key: Column) -> Column:
    """The folder of a key; a constant for a literal key, so that a scan is pruned by it."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def batch_folder(path: str, batch_id: int, run: str = NO_RUN) -> str:
    """The folder of one batch of one run."""
    return f"{path}/{RUN}={run}/{BATCH}={batch_id}"


def _write(rows: DataFrame, folder: str, key: str) -> None:
    """Rows into folders by key hash. Adaptive execution joins and splits them by size."""
    (
        rows.withColumn(BUCKET, bucket_of(F.col(key))).hint("rebalance", BUCKET)
        .write.mode("overwrite").partitionBy(BUCKET)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(folder)
    )


def write_batch(
    rows: DataFrame, path: str, batch_id: int, key: str, order: list[str], run: str = NO_RUN
) -> None:
    """Store the last version per key of one batch; writing the batch again replaces it."""
    _write(latest_per_key(rows, [key], order), batch_folder(path, batch_id, run), key)


def versions(spark: SparkSession, path: str, schema: StructType = schemas.RESPONSE) -> DataFrame:
    """Every stored version with its run, batch and bucket."""
    stored = StructType([*schema.fields]).add(RUN, StringType()).add(BATCH, LongType())
    stored = stored.add(BUCKET, IntegerType())
    return spark.read.schema(stored).option("basePath", path).parquet(path)


def _last(rows: DataFrame, key: str, moment: list[str]) -> DataFrame:
    return latest_per_key(rows, [key], [*moment, RUN, BATCH]).drop(RUN, BATCH, BUCKET)


def read_latest(
    spark: SparkSession, path: str, key: str = "uuid", schema: StructType = schemas.RESPONSE,
    moment: list[str] = MOMENT,
) -> DataFrame:
    """One row per key: the version with the latest ``moment``, then of the latest run and batch.

    Queries that run side by side may both answer a key; the row's own time decides, not which
    query was started later.
    """
    return _last(versions(spark, path, schema), key, moment)


def look_up(
    spark: SparkSession, path: str, value: str, key: str = "uuid",
    schema: StructType = schemas.RESPONSE, moment: list[str] = MOMENT,
) -> DataFrame:
    """The current row of one key, or none: one folder of each batch is read, not the history."""
    mine = versions(spark, path, schema).where(
        (F.col(BUCKET) == bucket_of(F.lit(value))) & (F.col(key) == F.lit(value))
    )
    return _last(mine, key, moment)


def look_up_many(
    spark: SparkSession, path: str, values: DataFrame, key: str = "uuid",
    schema: StructType = schemas.RESPONSE, moment: list[str] = MOMENT,
) -> DataFrame:
    """The current rows of the keys in column ``key`` of ``values``; other rows leave before the sort.

    Where the keys are few enough to be broadcast, only their folders are read.
    """
    wanted = values.select(bucket_of(F.col(key)).alias(BUCKET), key).distinct()
    return _last(versions(spark, path, schema).join(wanted, [BUCKET, key], "semi"), key, moment)


def compact(
    spark: SparkSession, path: str, into: str, key: str = "uuid",
    schema: StructType = schemas.RESPONSE, moment: list[str] = MOMENT,
) -> None:
    """Write the current rows as the base of a new table; every later batch there is newer.

    Batches written to ``path`` meanwhile are not seen: stop its queries first, then let them go
    on, with the checkpoints they have or with new ones, writing to ``into``.
    """
    _write(read_latest(spark, path, key, schema, moment), batch_folder(into, _BASE), key)


def write_keys(keys: DataFrame, path: str, batch_id: int, key: str, run: str = NO_RUN) -> None:
    """Remember the keys of one batch; writing the batch again replaces them."""
    _write(keys.select(key), batch_folder(path, batch_id, run), key)


def unseen(
    rows: DataFrame, path: str, batch_id: int, key: str, run: str = NO_RUN, of: DataFrame | None = None
) -> DataFrame:
    """Rows whose key no other batch has remembered below ``path``, whenever that was.

    Only the folders of the hashes that ``rows`` has are read. What this batch itself remembered
    before it was replayed does not count. ``rows`` should hold each key once. The hashes are taken
    from ``of``, a table with the same keys that is cheaper to read, if there is one.
    """
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return rows
    marked = rows.withColumn(BUCKET, bucket_of(F.col(key)))
    hashes = (rows if of is None else of).select(bucket_of(F.col(key)).alias(BUCKET)).distinct()
    touched = [r[0] for r in hashes.collect()]  # at most BUCKETS numbers
    schema = StructType([StructField(key, rows.schema[key].dataType)])
    known = versions(spark, path, schema).where(
        F.col(BUCKET).isin(touched) & ~((F.col(RUN) == run) & (F.col(BATCH) >= batch_id))
    )
    return marked.join(known.select(BUCKET, key), [BUCKET, key], "left_anti").select(*rows.columns)
