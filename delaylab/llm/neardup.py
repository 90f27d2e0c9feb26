"""Exact Jaccard join of documents by word shingles, as a metric-space join with pivots.

Documents with equal shingle sets form a class; the join is between classes. Jaccard distance is
a metric, but unrelated texts all lie at distance 1 of each other, so a few pivot documents would
send nearly every document into every region. Regions are therefore opened around shingles first:
with all shingles in one order, rare ones first, two sets within the radius share one of the
first (1 - t) n + 1 of either (a set may lack no more than that of a partner's), so a region for
each such shingle holds every pair that can link.

The place of a shingle in a set bounds what the set can share: whatever stands before the first
common shingle is not common. Together with the size this gives each class a window of partner
sizes in each of its regions, and a class whose window holds no size of the region leaves it.

Within regions the join goes on in rounds. In a round each class is measured against one pivot of
another component, the one it meets in most of its regions. A region's first pivot is the class
whose shingle stands nearest to the front: it has fewest shingles of its own, so it lies nearest
to the middle of a group of copies; later pivots are drawn by a hash. Classes within the radius of
their pivot are linked, and join its component; what links a component needs no further pairs
inside it, so a group of copies costs one measurement per copy, not one per pair. Regions in which
one component is left are done.

What is left is joined inside cells. A set has 128 coordinates, its distances to the empty set
within 128 parts of the shingle space; the sum of their differences is a metric and never more
than what two sets differ by. A region over the budget of a task takes several pivots. Each class
goes to the cell of the nearest, and as a replica to every cell whose pivot is no further than that by
twice the most that it may differ from a partner: by the triangle inequality a pair that can link meets in
the cell of either. Cells over the budget take pivots of their own; one that pivots do not make smaller is cut
into tiles, and each pair of tiles is a task's work. Inside, a task compares coordinates and gives out only
the pairs that they, the sizes and the places of the shingle leave possible.

Every measurement counts the true intersection; the order of the shingles, the number of rounds
and the windows decide the cost alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylab.llm.components import connected
from delaylab.llm.scratch import dropped
from delaylab.llm.scratch import stored as materialize
from delaylab.llm.textbytes import VISIBLE_BYTES, Words, chunks, mix, sequence_hash

#: Documents of a block in which shingles are counted to find the frequent ones.
BLOCK_DOCS = 4096
#: Most frequent shingles that are put last in the order (8 bytes each on every executor).
FREQUENT = 1_000_000
#: Coordinates of a set.
PARTS = 128
#: Bits of the map that picks the classes whose sets are wanted (8 MB).
MAP_BITS = 26
#: Pairs left per class, counted in every region they share, at which the rounds end.
PAIRS_LEFT = 160
#: Classes that a task joins inside a cell, pivots of a larger one, and levels of cells in cells.
CELL, CELL_PIVOTS, CELL_LEVELS = 512, 16, 4
#: Cells of so few classes are joined by an ordinary join: at most half as many pairs as this a class.
FEW = 32
#: A cell that keeps more than this share of what was divided is cut into tiles instead.
STALLED = 0.8
#: Classes with more than this share of all documents; their component is broadcast.
HOT_SHARE = 0.001


class Sets:
    """The distinct shingles of each text of a chunk: sorted hashes, first place of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int):
        words = Words(data, offsets, VISIBLE_BYTES)
        n = len(words.counts)
        at, hashes = words.shingles(k)
        text = np.searchsorted(words.firsts[1:], at, side="right")
        few = np.flatnonzero((words.counts > 0) & (words.counts < k))
        if len(few):
            whole = [
                sequence_hash([words.hashes[words.firsts[i] + j : words.firsts[i] + j + 1]
                               for j in range(words.counts[i])])[0]
                for i in few
            ]
            text = np.concatenate([text, few])
            hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        self.text, self.hashes = text[new], hashes[new]
        self.starts = np.searchsorted(self.text, np.arange(n + 1))
        self.sizes = np.diff(self.starts)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hashes ^ np.uint64(0xA5A5A5A5)))])
        total = sums[self.starts[1:]] - sums[self.starts[:-1]]
        #: Hash of the whole set.
        self.classes = mix(total + self.sizes.astype(np.uint64)).view(np.int64)


def _classes(k: int, key_fields: list[str], names: list[str]):
    """A row per document, and a row per shingle met in several documents of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        known: set[int] = set()
        docs = 0

        def block() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_counts=True)
            often = counts > 1
            m = int(often.sum())
            columns = {
                "shingle": pa.array(values[often].view(np.int64)), "n": pa.array(counts[often].astype(np.int64)),
            }
            return pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else pa.nulls(m, kinds[c]) for c in names], names=names
            )

        kinds: dict[str, pa.DataType] = {}
        for batch in batches:
            kinds = {f: batch.schema.field(f).type for f in key_fields}
            kinds |= {"class": pa.int64()}
            text = batch.column(batch.schema.names.index("text"))
            for lo, hi, data, offsets in chunks(text):
                sets = Sets(data, offsets, k)
                named = [batch.column(batch.schema.names.index(f)).slice(lo, hi - lo) for f in key_fields]
                columns = dict(zip(key_fields, named)) | {
                    "class": pa.array(sets.classes, mask=sets.sizes == 0),
                    "n": pa.array(sets.sizes.astype(np.int64)), "shingle": pa.nulls(hi - lo, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
                for i in range(hi - lo):
                    c = int(sets.classes[i])
                    if c not in known:
                        known.add(c)
                        docs += 1
                        hashes.append(sets.hashes[sets.starts[i] : sets.starts[i + 1]])
                if docs >= BLOCK_DOCS:
                    yield block()
                    hashes, known, docs = [], set(), 0
        if hashes:
            yield block()

    return run


def least_common(n: np.ndarray, percent: int) -> np.ndarray:
    """Elements that a partner of a set with ``n`` elements shares with it at least."""
    return -(-n * percent // 100)


def _prefixes(shared, k: int, percent: int):
    """(class, n, shingles in front, how many of them are not frequent, coordinates) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                sets = Sets(data, offsets, k)
                some = sets.sizes > 0
                if not some.any():
                    continue
                weight = np.zeros(len(sets.hashes), np.int64)
                if len(frequent):
                    place = np.minimum(np.searchsorted(frequent, sets.hashes), len(frequent) - 1)
                    weight = np.where(frequent[place] == sets.hashes, rank[place], 0)
                # Hashes are sorted within a text, so only texts with frequent shingles change.
                order = np.lexsort((sets.hashes, weight, sets.text)) if weight.any() else slice(None)
                hashes, weight = sets.hashes[order], weight[order]
                nth = np.arange(len(hashes)) - np.repeat(sets.starts[:-1], sets.sizes)
                length = sets.sizes - least_common(sets.sizes, percent) + 1
                front = nth < np.repeat(length, sets.sizes)
                cold = np.bincount(sets.text[front & (weight == 0)], minlength=len(sets.sizes))
                part = (mix(sets.hashes) >> np.uint64(57)).astype(np.int64)
                points = np.bincount(sets.text * PARTS + part, minlength=len(sets.sizes) * PARTS)
                points = np.minimum(points, 255).astype(np.uint8)[np.repeat(some, PARTS)]
                upto = np.concatenate([[0], np.cumsum(length[some])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.classes[some]), pa.array(sets.sizes[some].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(upto), pa.array(hashes[front].view(np.int64))),
                        pa.array(cold[some].astype(np.int32)), _blobs(points, np.full(int(some.sum()), PARTS)),
                    ],
                    names=["class", "n", "shingles", "cold", "points"],
                )

    return run


def _blobs(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    upto = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(upto.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _wanted(shared, k: int):
    """(class, n, set) of the documents whose class may be wanted; the join behind it is exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                sets = Sets(data, offsets, k)
                slot = sets.classes.view(np.uint64) >> np.uint64(64 - MAP_BITS)
                on = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                keep = (on == 1) & (sets.sizes > 0)
                if not keep.any():
                    continue
                data_kept = sets.hashes[np.repeat(keep, sets.sizes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.classes[keep]), _blobs(data_kept.view(np.uint8), sets.sizes[keep] * 8)],
                    names=["class", "set"],
                )

    return run


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int16)


def _allowed(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Most elements that two sets of these sizes may differ by if they link."""
    # inter >= percent/100 * union, and union + inter = n_a + n_b.
    return n_a + n_b - 2 * -(-(n_a + n_b) * percent // (100 + percent))


def _near(percent: int):
    """Pairs that sizes and coordinates leave possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            apart = np.abs(_points(batch.column(4)) - _points(batch.column(5))).sum(axis=1)
            keep = apart <= _allowed(n_a, n_b, percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"]
            )

    return run


_CELL_ROW = "cell long, class long, comp long, n long, at int, points binary, whole long"


def _to_cells(percent: int):
    """Each row to the cell of its nearest pivot, and to those within the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, n = _points(batch.column("points")), batch.column("n").to_numpy()
            cell = batch.column("cell").to_numpy()
            rows, into = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            # The pivots of a cell are read once for each run of its rows.
            cuts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            for lo, hi in zip(cuts, [*cuts[1:], len(cell)]):
                pivots = _points(batch.column("pivots")[lo].values)
                far = np.stack([np.abs(points[lo:hi] - p).sum(axis=1) for p in pivots], axis=1)
                reach = n[lo:hi] * (100 - percent) // percent
                row, k = np.nonzero(far <= (far.min(axis=1) + 2 * reach)[:, None])
                rows.append(row + lo)
                into.append(mix((cell[row + lo] * 31 + k + 1).view(np.uint64)).view(np.int64))
            taken = pa.array(np.concatenate(rows))
            names = ["class", "comp", "n", "at", "points", "m"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(into)), *(batch.column(c).take(taken) for c in names)],
                names=["cell", *names[:-1], "whole"],
            )

    return run


def _inside(percent: int):
    """(a, b): pairs of a cell, of different components, that may link."""

    def run(cell: pa.Table) -> pa.Table:
        columns = [cell.column(c).to_numpy() for c in ("class", "comp", "n", "at", "side")]
        columns.append(_points(cell.column("points")))
        order = np.argsort(columns[2], kind="stable")
        cls, comp, n, at, side, points = (x[order] for x in columns)
        # Partners are no larger than this; they follow in the order of sizes.
        upto = np.searchsorted(n, n * 100 // percent, side="right")
        found_a, found_b = [], []
        for i in range(len(cls)):
            others = np.arange(i + 1, upto[i])
            # Where two tiles meet, the rows of one tile have met by themselves.
            others = others[(comp[others] != comp[i]) & ((side[others] == 0) | (side[others] != side[i]))]
            reach = np.minimum(n[i] - at[i], n[others] - at[others]) * (100 + percent) >= (n[i] + n[others]) * percent
            others = others[reach]
            if len(others):
                apart = np.abs(points[others] - points[i]).sum(axis=1)
                others = others[apart <= _allowed(n[i], n[others], percent)]
                found_a.append(np.full(len(others), cls[i]))
                found_b.append(cls[others])
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _measure(percent: int):
    """(a, b, common, total, linked) of pairs with both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                same = int((y[at] == x).sum())
                common.append(same)
                total.append(len(x) + len(y) - same)
            common, total = np.array(common, np.int64), np.array(total, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array(1 - common / np.maximum(total, 1)), pa.array(100 * common >= percent * total),
                ],
                names=["a", "b", "distance", "linked"],
            )

    return run


class _Join:
    """The state of one join: documents, classes, regions."""

    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.docs, self.k, self.percent = docs, k, percent
        self.spark = docs.sparkSession

    def classes(self) -> DataFrame:
        """(row, key, n, class) of every document; finds the frequent shingles on the way."""
        names = ["row", "key", "class", "n", "shingle"]
        schema = T.StructType([
            T.StructField("row", T.LongType()), self.docs.schema["key"],
            *(T.StructField(c, T.LongType()) for c in names[2:]),
        ])
        rows = materialize(
            self.docs.mapInArrow(_classes(self.k, ["row", "key"], names), schema), "classes"
        )
        often = materialize(
            rows.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 4"),
            "frequent",
        )
        # The least number of documents that at most FREQUENT shingles reach.
        levels = often.groupBy("n").count().orderBy(F.desc("n")).limit(100_000).collect()
        least, room = 0, FREQUENT
        for r in levels:
            room -= r["count"]
            if room < 0:
                break
            least = r.n
        self.frequent = often.where(F.col("n") >= least) if least else often.limit(0)
        docs = materialize(rows.where("shingle is null").select("row", "key", "n", "class"), "documents")
        self.frequent = materialize(self.frequent, "frequent")
        dropped(rows, often)
        return docs

    def regions(self) -> tuple[DataFrame, DataFrame]:
        """(shingle, class, n, at) where a shingle opens several prefixes, and (class, n, points).

        ``at`` is the shingle's place in the class.
        """
        rows = self.frequent.toArrow()
        values = rows["shingle"].to_numpy().view(np.uint64)
        order = np.argsort(values)
        counts = rows["n"].to_numpy()
        shared = self.spark.sparkContext.broadcast((values[order], counts[order]))
        found = self.docs.select("text").mapInArrow(
            _prefixes(shared, self.k, self.percent),
            "class long, n long, shingles array<long>, cold int, points binary",
        )
        # One document stands for its class; copies are dropped before and behind the shuffle.
        one = found.groupBy("class").agg(*(
            F.any_value(c).alias(c) for c in ("n", "shingles", "cold", "points")
        ))
        fronts = materialize(one, "fronts")
        opened = fronts.select(
            "class", F.col("n").cast("int").alias("n"), "cold", F.posexplode("shingles").alias("at", "shingle")
        )
        named = ["shingle", "class", "n", "at"]
        group = Window.partitionBy("shingle")
        shared_ones = (
            opened.where("at < cold").select(*named)
            .withColumn("lo", F.min("class").over(group)).withColumn("hi", F.max("class").over(group))
            .where("lo <> hi").select(*named)
        )
        # Frequent shingles are shared anyway and could be hot: they need no look at their group.
        regions = shared_ones.unionByName(opened.where("at >= cold").select(*named))
        kept = materialize(regions, "regions"), materialize(fronts.select("class", "n", "points"), "points")
        dropped(fronts)
        return kept

    def measured(self, pairs: DataFrame, points: DataFrame) -> DataFrame:
        """(a, b, distance, linked) of the pairs that sizes and coordinates leave possible."""
        side = lambda x: points.select(
            F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("points").alias(f"points_{x}")
        )
        low = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        seen = pairs.join(side("a"), "a").join(side("b"), "b").where(low)
        near = materialize(
            seen.select("a", "b", "n_a", "n_b", "points_a", "points_b")
            .mapInArrow(_near(self.percent), "a long, b long"),
            "near-pairs",
        )
        return self.exact(near)

    def exact(self, near: DataFrame) -> DataFrame:
        """(a, b, distance, linked) of stored pairs, by their whole sets."""
        needed = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class"))).distinct()
        needed = materialize(needed, "needed")
        bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        slots = needed.select(F.shiftrightunsigned("class", 64 - MAP_BITS).alias("slot"))
        packed = slots.groupBy(F.expr("slot div 8").alias("byte")).agg(
            F.expr("bit_or(shiftleft(1, cast(slot % 8 as int)))").alias("bits")
        )
        # At most one row per byte of the map, whatever the number of classes.
        for r in packed.toLocalIterator():
            bits[r.byte] = r.bits
        sets = self.docs.select("text").mapInArrow(
            _wanted(self.spark.sparkContext.broadcast(bits), self.k), "class long, set binary"
        )
        sets = materialize(
            sets.join(needed, "class", "left_semi").groupBy("class").agg(F.any_value("set").alias("set")),
            "sets",
        )
        both = near.join(sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a").join(
            sets.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b"
        )
        found = materialize(
            both.select("a", "b", "set_a", "set_b").mapInArrow(
                _measure(self.percent), "a long, b long, distance double, linked boolean"
            ),
            "measured",
        )
        dropped(near, needed, sets)
        return found


def _labelled(regions: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(shingle, class, n, at, comp) of the regions that are still open; one that is done stays done."""
    regions = regions.select("shingle", "class", "n", "at")
    if labels is None:
        return regions.withColumn("comp", F.col("class"))
    named = labels.select(F.col("node").alias("class"), F.col("component").alias("comp"))
    return regions.join(named, "class", "left").select(
        "shingle", "class", "n", "at", F.coalesce("comp", "class").alias("comp")
    )


def _window(percent: int):
    """Smallest and largest size of a partner whose first common shingle is this row's."""
    # inter >= percent / 100 * union, union >= n and union = n + size - inter.
    smallest = F.expr(f"(n * {percent}L + 99) div 100")
    largest = F.expr(f"((n - at) * {100 + percent}L) div {percent} - n")
    return smallest, largest


def _in_reach(percent: int):
    """Whether x and y can link with the region's shingle as the first that they share."""
    return F.expr(
        f"least(x.n - x.at, y.n - y.at) * {100 + percent}L >= (x.n + y.n) * {percent}L"
    )


def jaccard_links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Classes and components of documents (row, key, text).

    Returns (row, key, n, class) of every document, ``class`` null without words, and
    (node, component) of the classes that link with another class.
    """
    join = _Join(docs, k, percent)
    rows = join.classes()
    regions, points = join.regions()
    links = labels = first = done = None
    left_before, round_ = None, 0
    while True:
        open_ = _labelled(regions, labels)
        # The region's pivot: first the class nearest to the middle, then one drawn by a hash.
        drawn = F.xxhash64("class", F.lit(round_))
        rank = F.struct("at", drawn.alias("h"), "class") if round_ == 0 else F.struct(drawn.alias("h"), "class")
        ends = open_.groupBy("shingle").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"),
            F.min_by(F.struct("class", "comp"), rank).alias("pivot"),
        )
        ends = ends.where("lo <> hi").drop("lo", "hi")
        smallest, largest = _window(percent)
        still = materialize(
            open_.join(ends, "shingle").where((smallest <= F.col("n_hi")) & (largest >= F.col("n_lo"))),
            "open-regions",
        )
        dropped(regions)
        regions = open_ = still
        # Pairs of different components, counted by region: all pairs less those inside one.
        inside = open_.groupBy("shingle", "comp").agg(F.count("*").cast("double").alias("n"))
        left = inside.groupBy("shingle").agg(
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")
        ).agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
        members = open_.select("class").distinct().count()
        if left == 0:
            break
        if left_before is not None and (left <= PAIRS_LEFT * members or left > 0.9 * left_before):
            break
        left_before, round_ = left, round_ + 1
        # Each class and the pivot of another component that it meets in most of its regions.
        met = (
            open_.where(F.col("comp") != F.col("pivot.comp"))
            .select("class", F.col("pivot.class").alias("pivot")).groupBy("class", "pivot").count()
        )
        best = met.groupBy("class").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
        pairs = best.select(F.col("class").alias("a"), F.col("pivot").alias("b"))
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        found = join.measured(pairs, points)
        done = pairs if done is None else done.unionByName(pairs)
        done = materialize(done, "done-pairs")
        if first is None:
            first = found.select(F.col("a").alias("class"), F.col("b").alias("pivot"), "distance")
        new = found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = new if links is None else links.unionByName(new)
        labels = materialize(connected(links), "labels")
    if left:
        found = join.exact(materialize(_cell_pairs(open_, points, percent), "cell-pairs"))
        new = found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        labels = materialize(connected(new if links is None else links.unionByName(new)), "labels")
    if labels is None:
        labels = docs.sparkSession.createDataFrame([], "node long, component long")
    return rows, labels


def _cell_pairs(open_: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of different components in the open regions that may link."""
    rows = open_.select(
        F.col("shingle").alias("cell"), "class", "comp", F.col("n").cast("long").alias("n"),
        F.col("at").cast("int").alias("at"),
    ).join(points.select("class", "points"), "class").select(
        "cell", "class", "comp", "n", "at", "points", F.lit(None).cast("long").alias("whole")
    )
    few, cells = [], []
    for level in range(CELL_LEVELS + 1):
        rows = materialize(rows, "cells")
        sizes = rows.groupBy("cell").agg(
            F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
        ).where("lo <> hi").select("cell", "m")
        sized = rows.join(materialize(sizes, "cell-sizes"), "cell")
        few.append(sized.where(F.col("m") <= FEW))
        whole = F.lit(0).cast("int").alias("side")
        cells.append(sized.where((F.col("m") > FEW) & (F.col("m") <= CELL)).select("*", whole))
        large = sized.where(F.col("m") > CELL)
        # What pivots did not make smaller is cut into tiles.
        stalled = F.lit(level == CELL_LEVELS) | F.coalesce(F.col("m") > STALLED * F.col("whole"), F.lit(False))
        cells.append(_tiles(large.where(stalled)))
        large = materialize(large.where(~stalled), "large-cells")
        if large.isEmpty():
            break
        # About CELL_PIVOTS classes of each cell, drawn by a hash; one at least.
        drawn = F.pmod(F.xxhash64("class", "cell", F.lit(level)), F.col("m")) < CELL_PIVOTS
        chosen = large.groupBy("cell").agg(
            F.collect_set(F.when(drawn, F.col("points"))).alias("drawn"), F.max("points").alias("one")
        )
        pivots = F.when(F.size("drawn") > 0, F.col("drawn")).otherwise(F.array("one"))
        chosen = materialize(chosen.select("cell", pivots.alias("pivots")), "cell-pivots")
        rows = large.join(chosen, "cell").drop("whole").mapInArrow(_to_cells(percent), _CELL_ROW)
    x, y = (_union(few).alias(name) for name in ("x", "y"))
    pairs = x.join(
        y,
        (F.col("x.cell") == F.col("y.cell")) & (F.col("x.class") < F.col("y.class"))
        & (F.col("x.comp") != F.col("y.comp")) & _in_reach(percent),
    ).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.col("x.n").alias("n_a"),
        F.col("y.n").alias("n_b"), F.col("x.points").alias("points_a"), F.col("y.points").alias("points_b"),
    )
    names = ["cell", "class", "comp", "n", "at", "points", "side"]
    inside = _union(cells).select(*names).groupBy("cell").applyInArrow(_inside(percent), "a long, b long")
    return pairs.mapInArrow(_near(percent), "a long, b long").unionByName(inside).distinct()


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows of large cells as cells of two tiles each, so that every two rows meet in one of them."""
    count = F.ceil(F.col("m") / CELL).cast("int")
    mine = F.pmod(F.xxhash64("class"), count).cast("int")
    dealt = rows.withColumn("_mine", mine).withColumn("_with", F.explode(F.sequence(F.lit(0), count - 1)))
    low, high = F.least("_mine", "_with"), F.greatest("_mine", "_with")
    side = F.when(low == high, 0).when(F.col("_mine") == low, 1).otherwise(2)
    named = dealt.withColumns({"side": side.cast("int"), "_pair": F.xxhash64("cell", low, high)})
    return named.withColumn("cell", F.col("_pair")).drop("_mine", "_with", "_pair")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """(row, key, n_shingles, component, first) of every document.

    Words are runs without white space, A-Z lowered; a document's set holds its distinct shingles
    of ``k`` words, or its whole word sequence if it has fewer. Two documents link if 100 times
    the intersection is at least ``percent`` times the union. ``component`` is the smallest key
    that links reach, the document's own included, and ``first`` the row that has it (the first of
    several); ``row`` numbers the rows of ``docs``, which should come from files.

    Documents without words (null, empty, white space) have no shingles and link with nothing.
    Repeated rows and equal texts share a component. Null keys are ignored among others; a
    document that only reaches null keys has a null component. Texts are read whole. Other
    columns do not matter. An empty table gives an empty one. Sets and shingles are told apart by
    64-bit hashes.
    """
    return _grouped(_numbered(docs, key, text), k, percent)


def _with_class(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``found``, one row per class; rows without a class get nulls.

    The classes that more than a share of HOT_SHARE of all rows have are few, whatever the number of
    rows, and are broadcast. Their rows are dealt out in the join with the others.
    """
    rest = [c for c in found.columns if c not in ("class", "copies")]
    total = found.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("copies") > HOT_SHARE * total
    first = found.where(hot).select("class", F.struct(*rest).alias("_hot"))
    joined = rows.join(F.broadcast(first), "class", "left")
    open_ = F.col("_hot").isNull() & F.col("class").isNotNull()
    key = F.when(open_, F.struct(F.lit(0).alias("of"), F.col("class").alias("k")))
    spread = F.struct(F.lit(1).alias("of"), F.col("row").alias("k"))
    later = found.where(~hot).select(
        F.struct(F.lit(0).alias("of"), F.col("class").alias("k")).alias("_key"), F.struct(*rest).alias("_cold")
    )
    both = joined.withColumn("_key", F.coalesce(key, spread)).join(later, "_key", "left")
    told = F.coalesce("_hot", "_cold")
    return both.select(*rows.columns, *(told[c].alias(c) for c in rest))


def _grouped(numbered: DataFrame, k: int, percent: int) -> DataFrame:
    """:func:`near_duplicates` of documents (row, key, text)."""
    rows, labels = jaccard_links(numbered, k, percent)
    # One row per class from here on: copies are counted before anything is joined.
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.count("*").alias("copies"), F.min(order).alias("first")
    )
    classes = materialize(classes, "class-firsts")
    linked = labels.select(F.col("node").alias("class"), F.col("component").alias("comp"))
    linked = classes.join(linked, "class")
    least = linked.groupBy("comp").agg(F.min("first").alias("least"))
    known = linked.select("class", "comp").join(least, "comp").select("class", "least")
    found = materialize(
        classes.join(known, "class", "left").select("class", "copies", F.coalesce("least", "first").alias("least")),
        "classes-found",
    )
    return _with_class(rows, found).select(
        "row", "key", F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("least.key")).alias("component"),
        F.coalesce(F.col("least.row"), F.col("row")).alias("first"),
    )


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each component: the one with the smallest key, the first of equal keys.

    The rows are numbered once and stored, so that no later scan can give a number to another row.
    """
    numbered = materialize(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "numbered"
    )
    found = _grouped(
        numbered.select(
            "row", F.col(f"doc.`{key}`").alias("key"),
            F.coalesce(F.col(f"doc.`{text}`"), F.lit("")).alias("text"),
        ),
        k, percent,
    )
    # The rows that go are few beside those that stay, so they are the side to be sent.
    gone = materialize(found.where("row <> first").select("row"), "gone-rows")
    return numbered.join(gone, "row", "left_anti").select("doc.*")


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents by four-word shingles at 85 hundredths."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, k=4, percent=85).select(
        F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, hash(array_to_string(w[i:i + least(4, len(w)) - 1], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)
  GROUP BY ALL),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT a AS doc_id, a AS to_id FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.to_id = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(to_id) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

QUERIES = {"op9_ngram_jaccard_join": op9_ngram_jaccard_join}
ORACLE = {"op9_ngram_jaccard_join": _SQL}
