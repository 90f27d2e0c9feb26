"""Ranked lexical search over an index whose strata are documents of equal length normaliser.

Documents with the same normaliser m form a stratum. Inside it a term's contribution depends on
its frequency alone, so postings are grouped by term and frequency and the impact of a frequency is
computed once per stratum, not once per posting. A stratum is stored in blocks of bounded size,
sorted by m, so a common m is split like any other.

The largest frequency of each term in a block bounds what an item can score there. Items visit the
blocks in the order of these bounds, in two rounds: first the blocks with the highest bounds, whose
scores give each item a threshold, then every other block whose bound reaches it, while the
threshold of a task goes on rising. Blocks below are passed over, and no document that belongs to
the result can be in them: the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.scratch import stored as materialize
from delaylab.llm.textbytes import LETTER_BYTES_ANY_CASE, Words, chunks, ranges

#: Documents and postings after which a block of a stratum is closed.
BLOCK_DOCS, BLOCK_POSTINGS = 1024, 1 << 16
#: Terms of items (summed over the items) that are asked in one pass over the documents; each
#: task holds them, with about 40 bytes each.
ITEM_TERMS = 2_000_000
#: Blocks that each item visits to find its threshold.
FIRST_VISITS = 2
#: Accumulators of a task, and candidates it keeps before they are cut to the best of each item.
_CELLS, _WAITING = 1 << 21, 1 << 16
_NULL = np.iinfo(np.int64).max

_ROWS = "doc long, n long, terms array<int>, tfs array<int>"
_INDEX = (
    "m long, block long, docs array<long>, terms array<int>, impacts array<long>, "
    "ends array<int>, members array<int>"
)
_FOUND = "item long, doc long, score long"


def _list(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def _named(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.names.index(name))


def _numbers(column: pa.Array) -> np.ndarray:
    """Longs with null as the largest, so that it sorts last."""
    return column.fill_null(int(_NULL)).to_numpy(zero_copy_only=False)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    for batch in batches:
        items = _named(batch, "item").to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in chunks(_named(batch, "text")):
            words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
            pairs = np.unique(np.stack([words.text_of.astype(np.uint64), words.hashes]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items[lo:hi][pairs[0].astype(np.int64)]), pa.array(pairs[1].view(np.int64))],
                names=["item", "term"],
            )


def _doc_terms(shared):
    """Per document its number of terms, and the frequencies of the asked ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = len(vocabulary)
        for batch in batches:
            docs = _named(batch, "doc")
            for lo, hi, data, offsets in chunks(_named(batch, "text")):
                words = Words(data, offsets, LETTER_BYTES_ANY_CASE)
                place = np.minimum(np.searchsorted(vocabulary, words.hashes), size - 1)
                asked = vocabulary[place] == words.hashes
                pairs, tf = np.unique(words.text_of[asked] * size + place[asked], return_counts=True)
                cuts = np.searchsorted(pairs, np.arange(hi - lo + 1) * size)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.slice(lo, hi - lo), pa.array(words.counts.astype(np.int64)),
                        _list(pairs % size, cuts, pa.int32()), _list(tf, cuts, pa.int32()),
                    ],
                    names=["doc", "n", "terms", "tfs"],
                )

    return run


@dataclass(frozen=True)
class Scoring:
    """Integer form of the usual saturation: 1000 k1 / 100 and 100 b."""

    saturation: int = 8
    slope: int = 90

    def impacts(self, tf: np.ndarray, m: int) -> np.ndarray:
        tf = tf.astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + self.saturation * m)


def _blocks(scoring: Scoring):
    """Blocks of documents that follow each other in the order of m."""

    def block(m: int, number: int, parts: list[tuple]) -> pa.RecordBatch:
        docs = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        terms = np.concatenate([p[2] for p in parts])
        tfs = np.concatenate([p[3] for p in parts])
        member = np.repeat(np.arange(len(docs)), sizes)
        order = np.lexsort((member, tfs, terms))
        terms, tfs, member = terms[order], tfs[order], member[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])
        heads = np.flatnonzero(new)
        columns = {
            "docs": (docs, pa.int64()), "terms": (terms[heads], pa.int32()),
            "impacts": (scoring.impacts(tfs[heads], m), pa.int64()),
            "ends": (np.append(heads[1:], len(terms)), pa.int32()), "members": (member, pa.int32()),
        }
        arrays = [_list(v, np.array([0, len(v)]), kind) for v, kind in columns.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array([m]), pa.array([number]), *arrays], names=["m", "block", *columns]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        current, parts, docs, postings = None, [], 0, 0
        for batch in batches:
            ms = _named(batch, "m").to_numpy(zero_copy_only=False)
            ids = _numbers(_named(batch, "doc"))
            lists = _named(batch, "terms")
            cuts = lists.offsets.to_numpy()
            terms = lists.values.to_numpy(zero_copy_only=False)
            tfs = _named(batch, "tfs").values.to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(ms):
                if parts and (ms[lo] != current or docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS):
                    yield block(current, number, parts)
                    number, parts, docs, postings = number + 1, [], 0, 0
                current = int(ms[lo])
                hi = int(np.searchsorted(ms, current, side="right"))
                full = int(np.searchsorted(cuts, cuts[lo] + BLOCK_POSTINGS - postings, side="left"))
                hi = max(lo + 1, min(hi, lo + BLOCK_DOCS - docs, full))
                part = slice(cuts[lo], cuts[hi])
                parts.append((ids[lo:hi], np.diff(cuts[lo : hi + 1]), terms[part], tfs[part]))
                docs, postings = docs + hi - lo, postings + int(cuts[hi] - cuts[lo])
                lo = hi
        if parts:
            yield block(current, number, parts)

    return run


class _Asked:
    """Items as rows of term numbers, and the weight of each term."""

    def __init__(self, items: np.ndarray, terms: np.ndarray, vocabulary: np.ndarray):
        order = np.lexsort((terms, items))
        self.items, starts = np.unique(items[order], return_index=True)
        self.starts = starts
        self.terms = np.searchsorted(vocabulary, terms[order])
        self.owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        self.weights = np.zeros(len(vocabulary), np.int64)

    def bounds(self, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """Most that each item can score in a block with these (term, impact) entries."""
        best = np.zeros(len(self.weights), np.int64)
        last = np.append(terms[1:] != terms[:-1], True)  # a term's largest frequency comes last
        best[terms[last]] = self.weights[terms[last]] * impacts[last]
        return np.add.reduceat(best[self.terms], self.starts)


def _entries(batch: pa.RecordBatch, names: list[str]) -> Iterator[list[np.ndarray]]:
    """The arrays of each row."""
    columns = [_named(batch, n) for n in names]
    for i in range(batch.num_rows):
        yield [c[i].values.to_numpy(zero_copy_only=False) for c in columns]


def _best_blocks(shared):
    """The blocks of a task in which each item may score most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: _Asked = shared.value
        top = np.zeros((len(asked.items), FIRST_VISITS), np.int64)
        which = np.full_like(top, -1)
        for batch in batches:
            blocks = _named(batch, "block").to_numpy(zero_copy_only=False)
            for number, (terms, impacts) in zip(blocks, _entries(batch, ["terms", "impacts"])):
                bound = asked.bounds(terms, impacts)
                worst = np.argmin(top, axis=1)
                rows = np.flatnonzero(bound > top[np.arange(len(top)), worst])
                top[rows, worst[rows]], which[rows, worst[rows]] = bound[rows], number
        row, slot = np.nonzero(which >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int64)), pa.array(top[row, slot]), pa.array(which[row, slot])],
            names=["item", "bound", "block"],
        )

    return run


class _Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows = [np.zeros((3, 0), np.int64)]
        self.waiting = 0

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        self.rows.append(np.stack([item, doc, score]))
        self.waiting += len(item)
        if self.waiting > _WAITING:
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        rows, place = rows[:, place < self.k], place[place < self.k]
        full = place == self.k - 1
        self.least[rows[0, full]] = np.maximum(self.least[rows[0, full]], rows[2, full])
        self.rows, self.waiting = [rows], 0
        return rows


def _scores(shared, k: int, visits: bool):
    """The best documents of a task: of the named items only, or of all whose bound is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = shared.value
        found = _Best(len(asked.items), k, least)
        names = ["docs", "terms", "impacts", "ends", "members", *(["items"] if visits else [])]
        for batch in batches:
            for docs, terms, impacts, ends, members, *named in _entries(batch, names):
                active = asked.bounds(terms, impacts) >= found.least
                if visits:
                    wanted = np.zeros(len(active), bool)
                    wanted[named[0]] = True
                    active &= wanted
                if not active.any():
                    continue
                value = np.repeat(asked.weights[terms] * impacts, np.diff(ends, prepend=0))
                first = np.append(True, terms[1:] != terms[:-1])
                starts = np.zeros(len(asked.weights), np.int64)
                stops = np.zeros(len(asked.weights), np.int64)
                starts[terms[first]] = np.append(0, ends[:-1])[first]
                stops[terms[np.append(first[1:], True)]] = ends[np.append(first[1:], True)]
                here = np.flatnonzero(active)
                for lo in range(0, len(here), max(1, _CELLS // len(docs))):
                    group = here[lo : lo + max(1, _CELLS // len(docs))]
                    row = np.full(len(active), -1)
                    row[group] = np.arange(len(group))
                    pairs = np.flatnonzero(row[asked.owner] >= 0)
                    pairs = pairs[stops[asked.terms[pairs]] > 0]
                    term = asked.terms[pairs]
                    posting, pair = ranges(starts[term], stops[term])
                    total = np.zeros(len(group) * len(docs), np.int64)
                    cell = row[asked.owner[pairs]][pair] * len(docs) + members[posting]
                    np.add.at(total, cell, value[posting])
                    item, doc = np.nonzero(total.reshape(len(group), -1) >= found.least[group][:, None])
                    found.add(group[item], docs[doc], total[item * len(docs) + doc])
        item, doc, score = found.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=doc == _NULL), pa.array(score)],
            names=["item", "doc", "score"],
        )

    return run


def _store_index(rows: DataFrame, n_docs: int, n_terms: int, scoring: Scoring) -> DataFrame:
    """The index of the rows as a table; small row groups keep what is read at once small."""
    m = F.expr(
        f"{100 - scoring.slope} + cast((cast(n as decimal(19,0)) * cast({scoring.slope * n_docs}L "
        f"as decimal(19,0))) div cast({n_terms}L as decimal(19,0)) as bigint)"
    )
    placed = (
        rows.where(F.size("terms") > 0)
        .select("doc", "terms", "tfs", m.alias("m"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("m", "row").sortWithinPartitions("m", "row")
        .select("doc", "m", "terms", "tfs")
    )
    return materialize(
        placed.mapInArrow(_blocks(scoring), _INDEX), "search-index", **{"parquet.block.size": 8 << 20}
    )


def _weights(rows: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weight of every asked term, from the number of documents that hold it."""
    weights = np.zeros(size, np.int64)
    counted = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    held = counted.toArrow()
    for t, df in zip(held["t"].to_numpy(), held["df"].to_numpy()):
        weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1)))
    return weights


def _search_block(docs: DataFrame, pairs: DataFrame, k: int, scoring: Scoring) -> DataFrame:
    """(item, doc, score): the best documents of each task for the items of ``pairs``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    held = pairs.toArrow()
    item, term = (held[c].to_numpy() for c in ("item", "term"))
    term = term.view(np.uint64)
    vocabulary = np.unique(term)
    if len(vocabulary) == 0:
        return spark.createDataFrame([], _FOUND)
    asked = _Asked(item, term, vocabulary)
    rows = materialize(docs.mapInArrow(_doc_terms(context.broadcast(vocabulary)), _ROWS), "search-docs")
    n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_docs == 0:
        return spark.createDataFrame([], _FOUND)
    asked.weights = _weights(rows, n_docs, len(vocabulary))
    index = _store_index(rows, n_docs, n_terms, scoring)
    shared = context.broadcast(asked)
    best = index.select("block", "terms", "impacts").mapInArrow(
        _best_blocks(shared), "item long, bound long, block long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    visits = materialize(
        best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= FIRST_VISITS)
        .groupBy("block").agg(F.collect_list("item").alias("items")),
        "search-visits",
    )
    least = np.ones(len(asked.items), np.int64)
    first = index.join(visits, "block").mapInArrow(
        _scores(context.broadcast((asked, least)), k, True), _FOUND
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    reached = first.withColumn("place", F.row_number().over(order)).where(F.col("place") == k)
    reached = reached.select("item", "score").toArrow()
    least[reached["item"].to_numpy()] = reached["score"].to_numpy()
    found = index.mapInArrow(_scores(context.broadcast((asked, least)), k, False), _FOUND)
    names = spark.createDataFrame(
        pa.table({"item": np.arange(len(asked.items)), "_item": asked.items})
    )
    return found.join(names, "item").select(F.col("_item").alias("item"), "doc", "score")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", k: int = 10, scoring: Scoring = Scoring(),
    item_terms: int = ITEM_TERMS,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item, ``rank`` from 1, key, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z lowered, in whole
    texts. They are compared by 64-bit hashes. All arithmetic but the logarithm of a term's weight
    is in 64-bit integers. Equal scores are ordered by rising key, a null key last; documents that
    score 0 are no results, so an item may have fewer than ``k`` or none.

    ``key`` must be an integer below 2^63 - 1. Null and empty texts have no terms and do not count as documents. Each
    row is a document or an item of its own, repeated numbers too. An empty table on either side
    gives no rows. Other columns of both tables are ignored, whatever their names; column names may
    be written in any case. Items with more than ``item_terms`` terms between them are asked in several passes.
    """
    column = lambda df, name: F.col(f"`{next(c for c in df.columns if c.lower() == name.lower())}`")
    asked = materialize(
        items.select(
            column(items, item).alias("name"), column(items, item_text).alias("text"),
            F.monotonically_increasing_id().alias("item"),
        ),
        "search-items",
    )
    pairs = materialize(asked.select("item", "text").mapInArrow(_item_terms, "item long, term long"), "item-terms")
    blocks = max(1, -(-pairs.count() // item_terms))
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    texts = docs.select(column(docs, key).cast("long").alias("doc"), column(docs, text).alias("text"))
    found = None
    for number in range(blocks):
        part = _search_block(
            texts, pairs.where(F.col("part") == number).select("item", "term"), k, scoring
        )
        part = part if blocks == 1 else materialize(part, "search-found")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item), "rank", F.col("doc").alias(key), "score"
    )


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )


_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS t
  FROM benchmark),
c AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
p AS (
  SELECT r, doc_id, n, t, count(*) AS tf
  FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM b) GROUP BY r, doc_id, n, t),
v AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM p GROUP BY t), c),
s AS (
  SELECT item_id, r, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM b JOIN p USING (t) JOIN v USING (t), c GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(place AS INTEGER) AS "rank", doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
WHERE place <= 10
"""

QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLE = {"op11_ranked_search": _SQL}
