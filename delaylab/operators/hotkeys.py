"""Grouping and numbering that stay distributed when one key holds much of the data.

A window or ``collect_list`` puts every row of a group into one task. The helpers here
first count rows per group (a partial aggregate, so a hot key costs one row per task),
treat ordinary groups the ordinary way, and cut groups above a row limit into pieces.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylab.session import materialize

#: Rows of one group that a single task may sort or hold.
GROUP_ROWS = 1_000_000

_SIZE = "_group_rows"
_COPY = "_copy"
_SEAT = "_seat"
_SLICE = "_slice"
_FIRST = "_first"
_BEFORE = "_before"
_PLACE = "_place"
_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on ``keys``: a null key is a group like any other."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split_groups(df: DataFrame, keys: list[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups up to ``limit`` rows, and rows of larger groups with their size.

    The second frame is None where no group is larger, which is the usual case.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_SIZE))
    hot = materialize(counts.where(F.col(_SIZE) > limit), "hot-groups")
    if hot.isEmpty():
        return df, None
    match = same_keys(df, hot, keys)
    large = df.join(hot, match, "inner").select(df["*"], hot[_SIZE])
    return df.join(hot, match, "left_anti"), large


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    rank: str = "rank",
    total: str | None = None,
    limit: int = GROUP_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Add the 1-based position of every row in its group, and optionally the group size.

    ``order`` should list enough columns that ties are copies of each other. ``stored`` says
    that ``df`` is read straight from files, which saves writing it once more.
    """
    if not keys:
        return _number_by_range(df, [], order, rank, stored)
    small, large = split_groups(df, keys, limit)
    group = Window.partitionBy(*keys)
    numbered = small.withColumn(rank, F.row_number().over(group.orderBy(*order)).cast("long"))
    if total:
        numbered = numbered.withColumn(total, F.count(F.lit(1)).over(group))
    if large is None:
        return numbered
    pieces = _number_by_range(large, keys, order, rank)
    pieces = pieces.withColumnRenamed(_SIZE, total) if total else pieces.drop(_SIZE)
    return numbered.unionByName(pieces)


def _sort_by_range(stored: DataFrame, order: list[Column]) -> DataFrame:
    """Rows sorted over the cluster by ranges of some ``GROUP_ROWS`` rows at most.

    A sort has as many ranges as the session is configured with, however many rows there are;
    a table with too many rows for these gets more.
    """
    ranges = ceil(stored.count() / GROUP_ROWS)
    if ranges <= int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return stored.orderBy(*order)
    return stored.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def _number_by_range(
    df: DataFrame, keys: list[str], order: list[Column], rank: str, stored: bool = False
) -> DataFrame:
    """Positions from a range-partitioned sort: place in the partition plus what precedes it.

    The rows come from files so that ``_copy`` is the same on every attempt at a task; it
    lets the range partitioner cut between copies of one row. The sorted rows are written
    with their partition and place, so the partition sizes belong to exactly these rows.
    """
    columns = df.columns
    source = df if stored else materialize(df, "unsorted")
    stable = source.withColumn(_COPY, F.monotonically_increasing_id())
    ordered = _sort_by_range(stable, [*[F.col(k) for k in keys], *order, F.col(_COPY)])
    seated = materialize(
        ordered.select(*columns, F.monotonically_increasing_id().alias(_SEAT)), "sorted"
    ).withColumn(_SLICE, F.shiftright(_SEAT, _ROW_BITS))
    # One row per sort partition and group: as many rows as there are partitions and groups.
    slices = seated.groupBy(_SLICE, *keys).agg(
        F.count(F.lit(1)).alias(_BEFORE), F.min(_SEAT).alias(_FIRST)
    )
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        slices.withColumn(_BEFORE, F.coalesce(F.sum(_BEFORE).over(earlier), F.lit(0))), "slices"
    )
    match = (seated[_SLICE] == starts[_SLICE])
    if keys:
        match = match & same_keys(seated, starts, keys)
    place = seated[_SEAT] - starts[_FIRST] + starts[_BEFORE] + 1
    return seated.join(starts, match).select(*[seated[c] for c in columns], place.alias(rank))


def nest(
    df: DataFrame,
    keys: list[str],
    items: list[str],
    into: str,
    total: str,
    limit: int,
) -> DataFrame:
    """One document per key with its rows as a sorted array of structs.

    A group above ``limit`` rows becomes several documents, numbered by ``Part`` in array
    order, so that no document outgrows a task; ``total`` counts the rows of the whole key.
    """
    rows = df.select(*keys, *[c for c in items if c not in keys])
    item = F.struct(*items) if len(items) > 1 else F.col(items[0])
    small, large = split_groups(rows, keys, limit)
    documents = small.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total),
        F.lit(0).cast("long").alias("Part"),
        F.sort_array(F.collect_list(item)).alias(into),
    )
    if large is None:
        return documents
    place = "_place"
    pieces = _number_by_range(large, keys, [F.col(c) for c in items], place)
    part = F.floor((F.col(place) - 1) / limit).cast("long").alias("Part")
    return documents.unionByName(
        pieces.groupBy(*keys, F.col(_SIZE).alias(total), part)
        .agg(F.sort_array(F.collect_list(item)).alias(into))
    )


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in ``order``.

    Each task keeps one row of a key before the shuffle (a group limit below the window), so
    copies of a hot key do not travel, and rows are compared column by column, never packed.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_PLACE, place).where(F.col(_PLACE) == 1).drop(_PLACE)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last version of every key."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key; ties on ``order`` fall to the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return _one_per_key(df, keys, [F.col(c) for c in [*order, *rest]])
