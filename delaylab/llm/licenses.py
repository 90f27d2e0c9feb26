"""Short licence notices in documents, exact or with a few wrong letters.

A notice with at most k errors is split into k + 1 seeds; any text within k edits of it holds one
of the seeds unchanged. Seeds are searched in the normal form of a text (words joined by single
spaces); where one stands, the ``regex`` library matches the whole notice with bounded errors in
a window around it, and reports the edits. Notices without errors are one seed. Texts are read
whole and never shuffled; the list of notices is given in the call, not derived from data.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.textbytes import LETTER_BYTES_ANY_CASE, LOWER, Words, chunks, spare


@dataclass(frozen=True)
class Notice:
    """A phrase in normal form (lower-case words and single spaces), its label, allowed edits."""

    phrase: str
    label: str
    errors: int = 0


#: Notices found with a few errors; phrases are fixed values.
FUZZY = (
    Notice("licensed under the apache license version 2 0", "apache-2.0", 3),
    Notice("permission is hereby granted free of charge to any person", "mit", 4),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("licensed under cc by", "cc-by", 2),
    Notice("creative commons attribution", "cc-by", 3),
    Notice("this work is dedicated to the public domain", "public-domain", 3),
    Notice("all rights reserved", "reserved", 2),
)
#: The exact phrases of the registered query.
EXACT = (
    Notice("cc by", "cc-by"),
    Notice("general public license", "gpl"),
    Notice("all rights reserved", "reserved"),
)

_SPAN = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("phrase", T.StringType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("errors", T.IntegerType()),
    T.StructField("allowed", T.IntegerType()),
])


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """(place, part): k + 1 parts of near-equal length that make up the phrase."""
    n, parts = len(notice.phrase), notice.errors + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, notice.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The notices with their seeds and patterns."""

    def __init__(self, notices: Sequence[Notice]):
        for n in notices:
            if len(n.phrase.encode()) != len(n.phrase) or n.errors >= len(n.phrase):
                raise ValueError("a phrase is ASCII and longer than its number of errors")
        self.notices = [
            (n, [(place, part.encode()) for place, part in seeds(n)],
             regex.compile(
                 b"(?b)(?:" + regex.escape(n.phrase.encode(), literal_spaces=True)
                 + b"){e<=" + str(n.errors).encode() + b"}"
             ))
            for n in notices
        ]

    def places(self, text: bytes) -> list[tuple[Notice, int, int, int]]:
        """(notice, begin, end, errors) in a text in normal form with a space at either end."""
        found = []
        for notice, parts, pattern in self.notices:
            size, k = len(notice.phrase), notice.errors
            if k == 0:
                whole = b" " + parts[0][1] + b" "
                at = text.find(whole)
                while at >= 0:
                    found.append((notice, at + 1, at + 1 + size, 0))
                    at = text.find(whole, at + 1)
                continue
            begins = set()
            for place, part in parts:
                at = text.find(part)
                while at >= 0:
                    begins.add(at - place)
                    at = text.find(part, at + 1)
            matched = set()
            for first, last in _close(sorted(begins), k):
                # Edits before the seed move the begin by at most k, edits behind it the end.
                a, b = max(0, first - k - 1), min(len(text), last + size + 2 * k + 1)
                for m in pattern.finditer(text, a, b, overlapped=False):
                    matched.add((m.start(), m.end(), sum(m.fuzzy_counts)))
            found += [(notice, s, e, n) for s, e, n in _best(matched)]
        return found


def _close(begins: list[int], k: int) -> list[tuple[int, int]]:
    """(first, last) of begins that at most ``k`` edits tell apart: seeds of one place."""
    groups: list[tuple[int, int]] = []
    for begin in begins:
        if groups and begin - groups[-1][0] <= k:
            groups[-1] = (groups[-1][0], begin)
        else:
            groups.append((begin, begin))
    return groups


def _best(matches: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping matches the one with fewest errors, then the first.

    One sweep for each number of errors: what is kept is sorted and without overlaps, so a match
    is compared with its neighbours alone.
    """
    kept: list[tuple[int, int, int]] = []
    for errors in sorted({m[2] for m in matches}):
        starts, ends = [m[0] for m in kept], [m[1] for m in kept]
        added, upto = [], 0
        for s, e, n in sorted(m for m in matches if m[2] == errors):
            behind = bisect_right(ends, s)  # the first kept match that ends after this one begins
            if s >= upto and (behind == len(kept) or e <= starts[behind]):
                added.append((s, e, n))
                upto = e
        kept = sorted(kept + added)
    return kept


def _scan(notices: Sequence[Notice], text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            fields = batch.schema.names
            n_words = np.zeros(batch.num_rows, np.int64)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for lo, hi, data, offsets in chunks(batch.column(fields.index(text))):
                normal, cuts, counts = _normal(data, offsets)
                n_words[lo:hi] = counts
                whole = normal.tobytes()
                for i in range(hi - lo):
                    one = whole[cuts[i] : cuts[i + 1] + 1]
                    places = scanner.places(one)
                    spaces = np.flatnonzero(normal[cuts[i] : cuts[i + 1] + 1] == 32) if places else None
                    for notice, s, e, errors in places:
                        # A word follows each space, and the text begins with one.
                        first = max(0, int(np.searchsorted(spaces, s, side="right")) - 1)
                        last = first + max(1, len(one[s:e].split())) - 1
                        found[lo + i].append({
                            "label": notice.label, "phrase": notice.phrase,
                            "first_word": first, "last_word": last, "errors": errors,
                            "allowed": notice.errors,
                        })
            kind = pa.list_(pa.struct([
                ("label", pa.string()), ("phrase", pa.string()), ("first_word", pa.int64()),
                ("last_word", pa.int64()), ("errors", pa.int32()), ("allowed", pa.int32()),
            ]))
            new = {"n_words": pa.array(n_words), "notices": pa.array(found, kind)}
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(fields.index(n)) for n in names], names=names
            )

    return run


def _normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as lower-case words, each word after one space: (bytes, where texts begin, words)."""
    words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
    lengths = words.ends - words.starts + 1
    upto = np.concatenate([[0], np.cumsum(lengths)])
    source = np.repeat(words.starts - 1 - upto[:-1], lengths) + np.arange(upto[-1])
    normal = LOWER[data[source]] if len(source) else np.zeros(0, np.uint8)
    normal[upto[:-1]] = 32
    return np.append(normal, np.uint8(32)), upto[words.firsts], words.counts


def scan_notices(
    docs: DataFrame, notices: Sequence[Notice] = FUZZY, text: str = "text"
) -> DataFrame:
    """Adds ``n_words`` and ``notices`` to every document.

    ``notices`` lists each place: label, phrase, first and last word (words count from 0), the
    number of edits (letters inserted, deleted or replaced) and the number the notice allows. Words are
    runs of letters and digits after lowering A-Z; case and marks between words do not matter.
    Exact notices (no errors) are listed at every place where their words stand, overlapping ones
    too; of overlapping places of one fuzzy notice the one with fewest edits is listed.

    Null and empty texts have no words and no notices. Texts of any length are read whole, and
    repeated rows are judged one by one. Input columns named like a new one are replaced; the name
    of the text column may be written in any case. The time for a text grows as its length.
    """
    kept = spare(docs, ("n_words", "notices"))
    text = next(c for c in kept if c.lower() == text.lower())
    schema = T.StructType([f for f in docs.schema.fields if f.name in kept])
    schema = schema.add("n_words", "long").add("notices", T.ArrayType(_SPAN))
    run = _scan(tuple(notices), text, schema.names)
    return docs.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)


def op10_license_scans(spark, sf_dir: str) -> DataFrame:
    """Licence notices in all documents: the exact phrases and the fuzzy notices."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_notices(docs, (*EXACT, *FUZZY))
    base = F.filter("notices", lambda n: n["allowed"] == 0)
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    score = F.array_max(
        F.transform("notices", lambda n: 1.0 - n["errors"] / F.length(n["phrase"]))
    )
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first_word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["first_word"])).alias("last_word"),
        labels(F.transform("base", lambda b: b["label"])).alias("base_labels"),
        labels(F.transform("notices", lambda n: n["label"])).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


QUERIES = {"op10_license_scans": op10_license_scans}
ORACLE: dict[str, str] = {}
