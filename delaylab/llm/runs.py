"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The texts of a chunk are one sequence of numbers, one number per text and word, so that no match
leaves its text. Prefix doubling sorts the suffixes; only those that still tie are sorted again. The
ranks of every doubling are kept and give the longest common prefix of two suffixes exactly.

An interval of the array whose suffixes share exactly ``depth`` words is an inner node of the suffix
tree; it is never built, the previous and next smaller values of the LCP array bound it. A square of
period ``depth`` that cannot move one word to the right starts at suffixes i and i + depth of two
different children of one interval. One of the two lies outside the largest child, so it is enough to
take the suffixes of the smaller children and ask whether ISA[i + depth] or ISA[i - depth] lies in
the interval: n log n tests in all. Each such square is the last of its run. Moved to the left as far
as the words repeat, which is the common suffix of two prefixes, it gives the whole run; squares of a
multiple of the period give the same stretch and are merged by keeping the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.textbytes import CHUNK_BYTES, ranges, spare

#: A run has this many words at least, and its period this many times.
LEAST_LENGTH, LEAST_COPIES = 6, 4

RUN = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()),
])


def _sorted_suffixes(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4, ... symbols); equal prefixes have equal ranks.

    The last ranks are all different: they are the inverse suffix array.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    levels, step = [], 1
    keys, where, base = first[order], order, np.zeros(n, np.int64)
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    while True:
        new = np.ones(len(keys), bool)
        # A suffix keeps the place of the group that it was in and is told apart inside it.
        new[1:] = (keys[1:] != keys[:-1]) | (base[1:] != base[:-1])
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rank[where] = slots[heads][group]
        levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        sizes = np.diff(np.append(heads, len(keys)))
        tied = sizes[group] > 1
        if not tied.any():
            return order, levels
        slots, where = slots[tied], where[tied]
        base = rank[where]
        ahead = where + step
        keys = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        # Groups lie one after the other; a sort by (group, key) leaves each in its slots.
        turn = np.lexsort((keys, base))
        keys, base, where = keys[turn], base[turn], where[turn]
        order[slots] = where
        step *= 2


def _common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share from the left."""
    n = len(levels[0])
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        a[same] += 1 << k
        b[same] += 1 << k
        total[same] += 1 << k
    return total


def _smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For places ``at``: the nearest smaller value before and behind, the next one not larger."""
    n = len(lcp)
    tables, width = [lcp], 1
    while width * 2 <= n and int(tables[-1].max(initial=0)) > 0:
        last = tables[-1]
        tables.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    depth = lcp[at]

    def behind(limit: np.ndarray) -> np.ndarray:
        """First place after ``at`` whose value is below ``limit``, or n."""
        place = at + 1
        for k in range(len(tables) - 1, -1, -1):
            fits = np.flatnonzero(place + (1 << k) <= n)
            fits = fits[tables[k][place[fits]] >= limit[fits]]
            place[fits] += 1 << k
        return place

    place = at.copy()  # everything from ``place`` up to ``at`` is at least as deep
    for k in range(len(tables) - 1, -1, -1):
        fits = np.flatnonzero(place >= 1 << k)
        fits = fits[tables[k][place[fits] - (1 << k)] >= depth[fits]]
        place[fits] -= 1 << k
    return place - 1, behind(depth), behind(depth + 1)


def branching_squares(
    order: np.ndarray, levels: list[np.ndarray], least_copies: int = 2
) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every square that ends its run; with the period as interval depth.

    A run of ``least_copies`` periods has that many suffixes in the interval of its period, so
    smaller intervals are passed over.
    """
    n = len(order)
    isa = levels[-1].astype(np.int64)
    lcp = np.zeros(n, np.int64)
    tied = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    lcp[tied] = _common_prefix(levels, order[tied - 1], order[tied])
    at = np.flatnonzero(lcp)
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after, child_end = _smaller(lcp, at)
    # The suffixes from ``before`` up to ``after`` - 1 share ``depth`` symbols.
    large = after - before >= least_copies
    at, before, after, child_end = at[large], before[large], after[large], child_end[large]
    # A boundary opens the child to its right; the first of its interval also closes the one to its left.
    by_interval = np.lexsort((at, lcp[at], before))
    at, before, after, child_end = (x[by_interval] for x in (at, before, after, child_end))
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens = np.ones(len(at), bool)
    opens[1:] = (before[1:] != before[:-1]) | (lcp[at[1:]] != lcp[at[:-1]])
    interval = np.cumsum(opens) - 1
    left = np.maximum(before[opens], 0)
    starts = np.concatenate([left, at])
    ends = np.concatenate([at[opens], child_end])
    owner = np.concatenate([np.arange(len(left)), interval])
    depth = lcp[at[opens]]
    low, high = left, after[opens]
    # All children but one largest of each interval.
    ranked = np.lexsort((starts - ends, owner))
    largest = np.zeros(len(ranked), bool)
    largest[ranked[np.searchsorted(owner[ranked], np.arange(len(left)))]] = True
    small = ~largest
    leaf, child = ranges(starts[small], ends[small])
    node = owner[small][child]
    child_low, child_high = starts[small][child], ends[small][child]
    here, period = order[leaf], depth[node]
    found = []
    for other, first in ((here + period, here), (here - period, here - period)):
        valid = (other >= 0) & (other < n)
        rank = isa[np.where(valid, other, 0)]
        member = valid & (rank >= low[node]) & (rank < high[node])
        # In the same child they would share more than ``depth`` symbols: the square could move.
        member &= ~((rank >= child_low) & (rank < child_high))
        found.append(np.stack([first[member], period[member]]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def runs_of(symbols: np.ndarray, least_length: int = LEAST_LENGTH,
            least_copies: int = LEAST_COPIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs in a sequence of numbers, by start, then period."""
    none = np.zeros(0, np.int64)
    if len(symbols) < 2:
        return none, none, none
    order, levels = _sorted_suffixes(symbols)
    place, period = branching_squares(order, levels, least_copies)
    if len(place) == 0:
        return none, none, none
    # How far a square moves left: the common suffix of what ends before its two halves.
    n = len(symbols)
    _, back = _sorted_suffixes(symbols[::-1])
    moved = _common_prefix(back, n - place, n - place - period)
    start, length = place - moved, moved + 2 * period
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    wanted = first & (length >= np.maximum(least_length, least_copies * period))
    start, length, period = start[wanted], length[wanted], period[wanted]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _one_by_one(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number per text and word, and the first word of each text."""
    counts = np.array([len(w) for w in words], np.int64)
    flat = pa.array([w for text in words for w in text], pa.large_binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), counts)
    width = int(codes.max(initial=0)) + 1
    return owner * width + codes, np.concatenate([[0], np.cumsum(counts)])


def _scan(text: str, names: list[str], least_length: int, least_copies: int):
    def chunk(texts: list[bytes]) -> dict[str, pa.Array]:
        # Words end at the six ASCII characters that bytes.split() takes as white space.
        words = [t.split() for t in texts]
        symbols, firsts = _one_by_one(words)
        start, length, period = runs_of(symbols, least_length, least_copies)
        text_of = np.searchsorted(firsts, start, side="right") - 1
        lost = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(lost, start + period, 1)
        np.add.at(lost, start + length, -1)
        keep = np.cumsum(lost[:-1]) == 0
        whole = np.logical_and.reduceat(np.append(keep, True), np.minimum(firsts[:-1], len(keep)))
        collapsed = []
        for i, own in enumerate(words):
            if own and not whole[i]:
                own = [w for w, k in zip(own, keep[firsts[i] : firsts[i + 1]].tolist()) if k]
            collapsed.append(b" ".join(own).decode())
        begins = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
        fields = [start - firsts[text_of], length, period]
        runs = pa.StructArray.from_arrays([pa.array(x) for x in fields], names=RUN.names)
        return {
            "n_words": pa.array(np.diff(firsts)),
            "runs": pa.ListArray.from_arrays(pa.array(begins), runs),
            "collapsed": pa.array(collapsed, pa.string()),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_BYTES):
                    size += len(texts[hi])
                    hi += 1
                new = chunk(texts[lo:hi])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [new[n] if n in new else part.column(part.schema.names.index(n)) for n in names],
                    names=names,
                )
                lo = hi

    return run


def find_runs(
    docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH,
    least_copies: int = LEAST_COPIES,
) -> DataFrame:
    """Adds the periodic runs of each whole text, and the text without their repetitions.

    New columns: ``n_words``; ``runs``, an array of (start, length, period) in words from 0, by
    start, then period; ``collapsed``, the words outside the repeated part of any run, joined by one
    space. A run is a longest stretch of consecutive words with smallest period q in which words q
    apart are identical and which holds ``least_length`` words and ``least_copies`` periods or
    more (two at least). Its first q words stay unless another run repeats them.

    Words are what stands between ASCII white space; case counts. A null, empty or blank text has
    no words, no runs and an empty collapsed text. Every row is judged by itself: repeated rows
    give equal results, and there are no groups. A text is never cut: one above the chunk size is
    taken alone, with 4 bytes a word for each doubling of its longest repetition. No rows give no
    rows. Input columns with the name of a new one (any case) are replaced; the name of the text
    column may be written in any case.
    """
    if least_copies < 2:
        raise ValueError("a run has two copies of its period at least")
    kept = spare(docs, ("n_words", "runs", "collapsed"))
    text = next(c for c in docs.columns if c.lower() == text.lower())
    schema = T.StructType([f for f in docs.schema.fields if f.name in kept])
    schema = schema.add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string")
    rows = docs.select(
        *(F.col(f"`{c}`") for c in kept), *([] if text in kept else [F.col(f"`{text}`")])
    )
    return rows.mapInArrow(_scan(text, schema.names, least_length, least_copies), schema)


def looped(doc_id, text):
    """Every tenth text (by the CRC-32 of its number) with its end replaced by a repetition.

    Word i >= a becomes word a + (i - a) % p, with a and p drawn from the same checksum. A text
    without number or words stays as it is.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    state = F.struct(words.alias("w"), F.size(words).alias("n"), g.alias("g"))

    def turned(s):
        a = s["g"] % s["n"]
        p = 1 + F.floor((s["n"] - a) / (3 + s["g"] % 8))
        place = F.transform(
            F.sequence(F.lit(0), s["n"] - 1),
            lambda i: F.when(i < a, i).otherwise((a + (i - a) % p)).cast("int"),
        )
        return F.array_join(F.transform(place, lambda i: F.get(s["w"], i)), " ")

    # The one element makes the words a value that is computed once.
    made = F.get(F.transform(F.array(state), lambda s: F.when(s["n"] > 0, turned(s))), 0)
    return F.when((h % 10 == 0), F.coalesce(made, text)).otherwise(text)


def longest(runs):
    """The run with most words; of equals the first, then that of the smallest period."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best),
    )


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of all documents, a tenth of which are given a repetition."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_runs(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
        longest(F.col("runs")).alias("top"),
    ).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE: dict[str, str] = {}
