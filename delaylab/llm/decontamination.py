"""Benchmark passages in documents, by a prefix-filtered set join.

Every window of an item is a set of shingles that a document window of the same length must hold
completely. The shingles of all windows are ordered by how often they occur in the whole corpus;
for complete containment the necessary prefix of a window is its one rarest shingle. Documents
are joined with these prefix shingles only. A match fixes where the window would lie, so it must
fit between the ends of the document (positional and length bound); what is left is compared word
by word.

Items are taken in blocks of bounded size, and each block meets all documents in one pass without
a shuffle: there is no document group that could be hot, and no bound on the number of items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.textbytes import LETTER_BYTES_ANY_CASE, Words, chunks, sequence_hash, spare
from delaylab.llm.scratch import stored as materialize

#: Item windows that go to the executors at a time (some 300 bytes each).
BLOCK_WINDOWS = 500_000
#: Words of a shingle; shorter windows are one shingle.
SHINGLE = 5

_WINDOWS = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("window", T.BinaryType()),
    T.StructField("words", T.IntegerType()),
])
_SPANS = "array<struct<first:int,last:int>>"


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for lo, _, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
                rows = []
                for i, n in enumerate(words.counts):
                    first, size = int(words.firsts[i]), min(width, int(n))
                    for at in range(first, first + int(n) - size + 1 if n else first):
                        rows.append((items[lo + i], words.phrase(at, size), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.string()),
                        pa.array([r[1] for r in rows], pa.binary()),
                        pa.array([r[2] for r in rows], pa.int32()),
                    ],
                    names=_WINDOWS.names,
                )

    return run


def item_windows(items: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """Distinct windows with the sorted items they come from; items without words have none."""
    rows = items.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return (
        rows.mapInArrow(_windows(width), _WINDOWS)
        .groupBy("window", "words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


class _Block:
    """Windows of one block with their shingles, as arrays."""

    def __init__(self, rows: list, shingle: int):
        self.phrases = [bytes(r.window) for r in rows]
        self.items = [list(r["items"]) for r in rows]
        self.sizes = np.array([r.words for r in rows], np.int64)
        data = np.frombuffer(b"\n".join(self.phrases), np.uint8)
        lengths = np.array([len(p) + 1 for p in self.phrases], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        offsets[-1] = len(data)
        words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
        self.word_hashes, self.firsts = words.hashes, words.firsts
        #: Shingle lengths that occur, and for each (hash, window, place in the window).
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        text_of = words.text_of
        for k in sorted({min(shingle, int(n)) for n in set(self.sizes.tolist())}):
            at, hashes = words.shingles(k)
            window = text_of[at]
            fits = np.minimum(self.sizes[window], shingle) == k
            at, hashes, window = at[fits], hashes[fits], window[fits]
            self.by_length[k] = (hashes, window, at - self.firsts[window])


def _lookup(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and a bitmap of their leading bits that most other hashes miss."""
    keys = np.unique(keys)
    seen = np.zeros(1 << 22, bool)
    seen[keys >> np.uint64(42)] = True
    return keys, seen


def _find(hashes: np.ndarray, keys: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into hashes, index into keys) of the hashes among the keys."""
    maybe = np.flatnonzero(seen[hashes >> np.uint64(42)])
    if len(keys) == 0 or len(maybe) == 0:
        return maybe[:0], maybe[:0]
    place = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
    same = keys[place] == hashes[maybe]
    return maybe[same], place[same]


def _count(shared):
    """How often the shingles of a block occur: one row per shingle and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        counts = {k: np.zeros(len(keys), np.int64) for k, (keys, _) in tables.items()}
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
                for k, (keys, seen) in tables.items():
                    _, place = _find(words.shingles(k)[1], keys, seen)
                    np.add.at(counts[k], place, 1)
        for k, (keys, _) in tables.items():
            some = np.flatnonzero(counts[k])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), k, np.int32)),
                    pa.array(keys[some].view(np.int64)),
                    pa.array(counts[k][some]),
                ],
                names=["k", "hash", "n"],
            )

    return run


def _prefixes(block: _Block, counted: dict[int, dict[int, int]]) -> dict:
    """Per shingle length: sorted prefix shingles and, for each, the windows it stands for."""
    found = {}
    for k, (hashes, window, place) in block.by_length.items():
        known = counted.get(k, {})
        often = np.array([known.get(int(h), 0) for h in hashes.view(np.int64)], np.int64)
        order = np.lexsort((hashes, often, window))
        rarest = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
        rarest = rarest[np.argsort(hashes[rarest], kind="stable")]
        keys, seen = _lookup(hashes[rarest])
        starts = np.searchsorted(hashes[rarest], keys)
        found[k] = (keys, seen, np.append(starts, len(rarest)), window[rarest], place[rarest])
    return found


def _expand(starts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key found, every entry of the key: (index into place, entry)."""
    lengths = starts[place + 1] - starts[place]
    which = np.repeat(np.arange(len(place)), lengths)
    first = np.repeat(starts[place], lengths)
    return which, first + np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _matches(words: Words, block: _Block, prefixes: dict) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every true occurrence in a chunk."""
    at_all, window_all = [], []
    ends = words.firsts[1:]
    for k, (keys, seen, starts, window, place) in prefixes.items():
        at, hashes = words.shingles(k)
        hit, key = _find(hashes, keys, seen)
        if len(hit) == 0:
            continue
        which, entry = _expand(starts, key)
        text = np.searchsorted(ends, at[hit][which], side="right")
        begin = at[hit][which] - place[entry]
        size = block.sizes[window[entry]]
        fits = (begin >= words.firsts[text]) & (begin + size <= words.firsts[text + 1])
        at_all.append(begin[fits])
        window_all.append(window[entry][fits])
    if not at_all:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, window = np.concatenate(at_all), np.concatenate(window_all)
    # Hashes of all words first, then the words themselves.
    good = np.ones(len(at), bool)
    for j in range(int(block.sizes.max())):
        rest = np.flatnonzero(good & (block.sizes[window] > j))
        good[rest] = (
            words.hashes[at[rest] + j] == block.word_hashes[block.firsts[window[rest]] + j]
        )
    kept = [
        i for i in np.flatnonzero(good)
        if words.phrase(int(at[i]), int(block.sizes[window[i]])) == block.phrases[window[i]]
    ]
    return at[kept], window[kept]


def _mark(shared, text: str, names: list[str]):
    """Adds the hit spans and items of one block to those of the blocks before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, prefixes = shared.value
        for batch in batches:
            fields = batch.schema.names
            spans = batch.column(fields.index("_spans")).to_pylist()
            items = batch.column(fields.index("_items")).to_pylist()
            n_words = np.zeros(batch.num_rows, np.int64)
            for lo, hi, data, offsets in chunks(batch.column(fields.index(text))):
                words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
                n_words[lo:hi] = words.counts
                at, window = _matches(words, block, prefixes)
                order = np.argsort(at, kind="stable")
                at, window = at[order], window[order]
                texts = np.searchsorted(words.firsts[1:], at, side="right")
                edges = np.flatnonzero(np.diff(texts, prepend=-1))
                for a, b in zip(edges, np.append(edges[1:], len(at))):
                    row, first = lo + int(texts[a]), int(words.firsts[texts[a]])
                    found = list(spans[row] or [])
                    found += [
                        {"first": int(s) - first, "last": int(s) - first + int(n) - 1}
                        for s, n in zip(at[a:b], block.sizes[window[a:b]])
                    ]
                    spans[row] = _union(found)
                    more = {i for w in window[a:b] for i in block.items[w]}
                    items[row] = sorted(more.union(items[row] or []))
            columns = {
                "_spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                "_items": pa.array(items, pa.list_(pa.string())),
                "n_words": pa.array(n_words),
            }
            yield pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else batch.column(fields.index(c)) for c in names],
                names=names,
            )

    return run


def _union(spans: list[dict]) -> list[dict]:
    """Overlapping or touching spans as one."""
    joined: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if joined and s["first"] <= joined[-1]["last"] + 1:
            joined[-1] = {"first": joined[-1]["first"], "last": max(joined[-1]["last"], s["last"])}
        else:
            joined.append(dict(s))
    return joined


def find_overlaps(
    docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text",
    item_text: str = "text", width: int = 10, block_windows: int = BLOCK_WINDOWS,
    least_words: int = 1,
) -> DataFrame:
    """Adds to each document where it repeats windows of ``width`` words of the items.

    New columns: ``n_words``; ``hit_spans``, the words inside any occurrence as maximal runs
    (first, last; words count from 0); ``hit_items``, the items with occurring windows, as
    sorted strings. Words are runs of letters and digits after lowering A-Z. An item with fewer
    words than ``width`` is one window of all its words; without words it has none. Items with
    fewer words than ``least_words`` (from 1 to ``width``) are left out.

    Null and empty texts have no words and no hits; so has every document if ``items`` is empty.
    Null item numbers are left out of ``hit_items`` but their windows hit. Equal windows of
    several items name all of them; repeated rows are judged one by one. Input columns with the
    name of an output column are replaced.
    """
    new = ("n_words", "hit_spans", "hit_items", "_spans", "_items")
    kept = spare(docs, new)
    if not 1 <= least_words <= width:
        raise ValueError("least_words must lie between 1 and the width of a window")
    windows = item_windows(items, item, item_text, width).where(F.col("words") >= least_words)
    windows = materialize(windows, "windows")
    blocks = -(-windows.count() // block_windows)
    windows = windows.withColumn(
        "_block", F.pmod(F.xxhash64("window"), F.lit(max(blocks, 1)))
    )
    work = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.lit(None).cast(_SPANS).alias("_spans"),
        F.lit(None).cast("array<string>").alias("_items"),
        F.lit(0).cast("long").alias("n_words"),
    )
    text = next(c for c in kept if c.lower() == text.lower())
    spark = docs.sparkSession
    for number in range(max(blocks, 1)):
        rows = windows.where(F.col("_block") == number).collect()
        block = _Block(rows, SHINGLE)
        tables = {k: _lookup(hashes) for k, (hashes, _, _) in block.by_length.items()}
        counts = (
            docs.select(F.col(f"`{text}`"))
            .mapInArrow(_count(spark.sparkContext.broadcast(tables)), "k int, hash long, n long")
            .groupBy("k", "hash").agg(F.sum("n").alias("n")).collect()
        ) if rows else []
        known: dict[int, dict[int, int]] = {}
        for r in counts:
            known.setdefault(r.k, {})[r.hash] = r.n
        shared = spark.sparkContext.broadcast((block, _prefixes(block, known)))
        schema = work.schema
        work = work.mapInArrow(_mark(shared, text, schema.names), schema)
        if number + 1 < blocks:
            work = materialize(work, "overlaps")
    none = F.array().cast("array<string>")
    return work.select(
        *(F.col(f"`{c}`") for c in kept), "n_words",
        F.coalesce("_spans", F.array().cast(_SPANS)).alias("hit_spans"),
        F.coalesce("_items", none).alias("hit_items"),
    )


def hit_words(spans) -> F.Column:
    """Number of words inside the spans."""
    return F.aggregate(
        spans, F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1).cast("long")
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", width: int = 10,
    least_words: int | None = None, item_text: str = "text", **options
) -> DataFrame:
    """The documents without a word inside an occurring window; their columns are unchanged.

    Items with fewer words than ``least_words``, by default ``width``, drop nothing: the one
    window of an item such as "the" stands in most clean documents. Documents with null, empty or
    too short texts stay, repeated rows are judged one by one, and an empty table of items or
    documents leaves the documents as they are.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(f"`{text}`").alias("text"))
    least = width if least_words is None else least_words
    # Which items a window comes from does not matter here, so none are gathered.
    texts = items.select(F.lit("").alias("item"), F.col(f"`{item_text}`").alias("text")).distinct()
    found = find_overlaps(
        rows, texts, item="item", text="text", width=width, least_words=least, **options
    )
    return found.where(F.size("hit_spans") == 0).select("doc.*")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, with windows of ten words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_overlaps(docs, items)
    n_hit = hit_words(F.col("hit_spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN bw USING (k, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op2_decontamination": op2_decontamination}
ORACLE = {"op2_decontamination": _SQL}
