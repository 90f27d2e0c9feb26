"""Token sequences of one capacity, filled by multiway differencing.

A document becomes token ids with an end id. Its full windows are sequences of their own; what is
left is cut into short pieces. The pieces are dealt at random into groups of bounded size, and
each group is divided among windows by the largest differencing method: every piece starts as a
division of its own, whose first window holds it and whose other windows are empty; the two
divisions with the largest imbalance are merged, the fuller windows of one with the emptier
windows of the other, until one division is left. Its windows are nearly equal. When the fullest
exceeds the capacity, the group is divided again among more windows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm import tokens
from delaylab.llm.textbytes import spare
from delaylab.llm.scratch import stored as materialize

CAPACITY = 2048
#: Longest piece of a document's rest. Shorter pieces fill evenly, longer ones keep more context.
PIECE = 512
#: Pieces divided together, on average.
GROUP = 512
#: Groups that a task divides.
GROUPS_PER_TASK = 16
END_ID = 1
_CHUNK_CHARS = 1 << 19


def public_vocabulary() -> str:
    """JSON file of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bounds(total: int, capacity: int, piece: int) -> np.ndarray:
    """Where the pieces of a document begin, and its end: full windows, then equal short ones."""
    full = total // capacity
    rest = total - full * capacity
    short = -(-rest // piece)
    starts = np.arange(full + 1) * capacity
    inner = starts[-1] + (np.arange(1, short + 1) * rest) // max(short, 1)
    return np.concatenate([starts, inner])


def _cutter(vocabulary: str, text: str, names: list[str], capacity: int, piece: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.load(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= _CHUNK_CHARS):
                    size += len(texts[hi])
                    hi += 1
                ids, at = encoder.encode(texts[lo:hi])
                ids = np.insert(ids, at[1:], np.uint32(end_id))
                at = at + np.arange(len(at))
                bounds = [_bounds(int(n), capacity, piece) for n in np.diff(at)]
                counts = np.array([len(b) - 1 for b in bounds])
                row = np.repeat(np.arange(lo, hi), counts)
                start = np.concatenate([b[:-1] for b in bounds])
                length = np.concatenate([np.diff(b) for b in bounds])
                first = np.repeat(at[:-1], counts) + start
                # The pieces follow each other as the ids do: one buffer, cut at the piece ends.
                cuts = np.append(first, len(ids)).astype(np.int32) * 4
                blob = pa.Array.from_buffers(
                    pa.binary(), len(first),
                    [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
                )
                new = {
                    "start": pa.array(start.astype(np.int64)),
                    "length": pa.array(length.astype(np.int64)),
                    "doc_tokens": pa.array(np.repeat(np.diff(at), counts).astype(np.int64)),
                    "ids": blob,
                }
                kept = batch.select([n for n in names if n not in new]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [new[n] if n in new else kept.column(kept.schema.names.index(n)) for n in names],
                    names=names,
                )
                lo = hi

    return run


def cut_documents(
    docs: DataFrame, text: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, piece: int = PIECE, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of the token ids of each document, instead of its text.

    New columns: ``start`` (ids of the document before the piece), ``length``, ``doc_tokens``
    (all ids of the document with the end id) and ``ids`` (the piece's ids, 32 bits each,
    little-endian). A null text counts as empty and has the end id alone. Texts are encoded
    whole. Equal rows give equal pieces each. Columns with the name of a new one are replaced.
    """
    kept = [c for c in spare(docs, ("start", "length", "doc_tokens", "ids")) if c != text]
    schema = T.StructType([f for f in docs.schema.fields if f.name in kept])
    for name, kind in (("start", "long"), ("length", "long"), ("doc_tokens", "long"), ("ids", "binary")):
        schema = schema.add(name, kind)
    run = _cutter(vocabulary or public_vocabulary(), text, schema.names, capacity, piece, end_id)
    return docs.select(*(F.col(f"`{c}`") for c in [*kept, text])).mapInArrow(run, schema)


def difference(lengths: list[int], windows: int) -> tuple[np.ndarray, list[list[int]]]:
    """Divide ``lengths`` among ``windows``: (sum of each window, members of each window)."""
    heap = []
    for i, n in enumerate(lengths):
        sums = np.zeros(windows, np.int64)
        sums[0] = n
        heap.append((-n, i, sums, [[i], *([] for _ in range(windows - 1))]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        # Fullest first in one and emptiest first in the other, so that imbalances oppose.
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        members = [in_a[k] + in_b[windows - 1 - k] for k in order.tolist()]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tie, sums, members))
    if not heap:
        return np.zeros(windows, np.int64), [[] for _ in range(windows)]
    return heap[0][2], heap[0][3]


def fill(lengths: list[int], capacity: int) -> list[list[int]]:
    """Members of each window, none above ``capacity``; as few windows as differencing allows."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        sums, members = difference(lengths, windows)
        if int(sums.max(initial=0)) <= capacity:
            return [m for m in members if m]
        windows += max(1, windows // 200)


def _divide(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_piece", ignore_index=True)
        lengths = group["length"].tolist()
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for number, members in enumerate(fill(lengths, capacity)):
            place = 0
            for i in members:
                sequence[i], offset[i] = number, place
                place += lengths[i]
        sequence_id = (group["_group"].to_numpy() << 24 | sequence) << 1
        return pd.DataFrame({"_piece": group["_piece"], "sequence_id": sequence_id, "offset": offset})

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Pieces of one sequence lie one after the other from offset 0 and never exceed ``capacity``.
    A piece as long as the capacity is a sequence by itself. The others are dealt into groups by
    their number in the input, not by their content, so neither copies nor repeated rows make a
    large group. Each piece is placed exactly once. Null or other lengths raise an error; no
    pieces give no sequences. Columns named like the new ones are replaced; all others, token ids
    among them, stay with their piece and do not go through the grouping.
    """
    kept = spare(pieces, ("sequence_id", "offset", "_piece", "_group"))
    checked = F.when(
        F.col("length").between(1, capacity), F.col("length").cast("long")
    ).otherwise(F.raise_error(F.lit("a piece must have from 1 to as many ids as a sequence")))
    numbered = materialize(
        pieces.select(*(F.col(f"`{c}`") for c in kept))
        .withColumn("length", checked)
        .withColumn("_piece", F.monotonically_increasing_id()),
        "pieces",
    )
    short = numbered.where(F.col("length") < capacity)
    groups = max(1, round(short.count() / group_size))
    group = F.pmod(F.xxhash64("_piece"), F.lit(groups)).cast("long").alias("_group")
    # Dividing costs time and few bytes: the tasks are made by groups, not by size.
    dealt = short.select("_piece", "length", group).repartition(-(-groups // GROUPS_PER_TASK), "_group")
    places = materialize(
        dealt.groupBy("_group").applyInPandas(
            _divide(capacity), "_piece long, sequence_id long, offset long"
        ),
        "places",
    )
    columns = [*(F.col(f"`{c}`") for c in kept), F.col("sequence_id"), F.col("offset")]
    full = numbered.where(F.col("length") == capacity).select(
        *(F.col(f"`{c}`") for c in kept),
        F.expr("shiftleft(_piece, 1) | 1").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(short.join(places, "_piece").select(*columns))


def packed_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """Every piece of all documents with its place, the CRC-32 of its ids and, mostly, its ids.

    ``ids`` are 32 bits each, little-endian; without ``with_ids`` they are dropped before
    anything is stored. A null text is a document of its end id alone; repeated rows are packed
    one by one, and no documents give no pieces.
    """
    pieces = cut_documents(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), text)
    marked = pieces.withColumn("ids_crc32", F.crc32("ids"))
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pack(marked if with_ids else marked.drop("ids")).select(*names, *["ids"] * with_ids)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed_documents(docs, with_ids=False)


QUERIES = {"op4_packing": op4_packing}
ORACLE: dict[str, str] = {}
