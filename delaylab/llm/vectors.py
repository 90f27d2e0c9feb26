"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets the signs of its products with random directions, one bit each, put
behind each other. Vectors are sorted by that number within their label; two vectors at a small
angle agree in most signs, so they often stand close together. Each is compared with a bounded number
of followers, and pairs whose true cosine is high enough are joined. Passes use other directions;
a pair that one pass keeps apart meets in another. Their number follows from the rows of the
largest label, so that the expected share of pairs found is the same at every size.

The sorted order is cut into blocks of equal length that share as many rows as a window has, so no
label and no group of copies decides how much a task gets. Equal vectors are one class from the
start. A block sends on a spanning forest of its links and not its pairs.

The links of a vector are counted within its component, again without making pairs: unit vectors
whose distances to the middle of the component add up to no more than the radius of the threshold
are linked for certain. Only where that leaves a doubt, blocks of members, sorted by their
distance to the middle, are multiplied with each other; block pairs beyond doubt are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylab.llm.components import connected
from delaylab.llm.scratch import stored as materialize
from delaylab.operators.hotkeys import number_rows

#: Followers that a vector is compared with in a pass.
WINDOW = 64
#: Rows of a block, and members of a component that are multiplied at once.
BLOCK, TILE = 1024, 256
#: Expected share of pairs at the threshold that some pass brings together.
RECALL = 0.99
#: Signs of a pass; neighbours are told apart by the first ones, as many as the rows need.
_BITS = 62
#: Distances to the middle are trusted up to this much.
_DOUBT = 1e-9


def passes_needed(rows: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at ``threshold`` has met in a window with probability ``recall``.

    A sign is the same for both with 1 - angle / pi. Rows that agree in b signs are a 2^-b part
    of all, so a pair stands within the window once it agrees in as many signs as leave no more
    rows than that; one more makes up for pairs that a cut tears apart.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    bits = math.log2(max(1.0, rows / window)) + 1
    met = same**bits
    return 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log(1 - met))


def usable(vector):
    """Whether a vector has a direction: not null, not empty, finite throughout, not all zero."""
    def finite_number(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    finite = F.forall(vector, finite_number)
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.Array, lo: int, hi: int) -> np.ndarray:
    """Unit vectors of rows that are equally long."""
    part = column.slice(lo, hi - lo)
    flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(hi - lo, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares may overflow or vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _directions(seed: int, dim: int, passes: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * _BITS))


def _sign_keys(passes: int, seed: int):
    """A row for each class and pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        places = np.int64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.int64)
        for part, x in _by_length(batches):
            n, dim = x.shape
            if dim not in known:
                known = {dim: _directions(seed, dim, passes)}
            keys = (x @ known[dim] >= 0).reshape(n, passes, _BITS) @ places
            many = part.select(["cls", "lab", "dim"]).take(pa.array(np.repeat(np.arange(n), passes)))
            number = np.tile(np.arange(passes, dtype=np.int32), n)
            yield pa.RecordBatch.from_arrays(
                [*many.columns, pa.array(number), pa.array(keys.ravel())],
                names=["cls", "lab", "dim", "pass", "sign"],
            )

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows is connected with by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _window_links(threshold: float, window: int):
    """Links of each block's rows with their followers, as a forest."""

    def links(place: np.ndarray, last: int, cls: np.ndarray, x: np.ndarray):
        """``last``: the place up to which rows belong to the block itself."""
        a, b = [], []
        for d in range(1, min(window, len(x) - 1) + 1):
            near = np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold
            near &= place[:-d] <= last
            found = np.flatnonzero(near)
            a.append(found)
            b.append(found + d)
        if not a:
            return cls[:0], cls[:0]
        root = _forest(len(x), np.concatenate(a), np.concatenate(b))
        child = np.flatnonzero(root != np.arange(len(x)))
        return cls[child], cls[root[child]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blockwise(batches, "block"):
            block = batch.column("block")[0].as_py()
            place = batch.column("place").to_numpy()
            run_of = batch.column("run").to_numpy()
            cls = batch.column("cls").to_numpy()
            cuts = np.flatnonzero(np.append(True, run_of[1:] != run_of[:-1]))
            for lo, hi in zip(cuts, [*cuts[1:], len(cls)]):
                x = _rows(batch.column("v"), lo, hi)
                u, v = links(place[lo:hi], (block + 1) * BLOCK, cls[lo:hi], x)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def _blockwise(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Rows that follow each other with one value of ``name``, together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(name).to_numpy()
        cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(values)]):
            if held and held[0].column(name)[0].as_py() != values[lo]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def _classes(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, its class) of all usable rows, and the classes: equal vectors of one label.

    Rows are compared by 128 bits of hashes of their components, so that a much repeated vector
    is counted before it travels.
    """
    keyed = source.where("usable").select(
        "row", "vec", F.xxhash64("lab", "v").alias("h"), F.xxhash64(F.lit(1), "v", "lab").alias("g")
    )
    classes = materialize(
        keyed.groupBy("h", "g").agg(
            F.min("row").alias("cls"), F.count("*").alias("w"), F.min("vec").alias("least")
        ),
        "vector-classes",
    )
    members = materialize(keyed.join(classes, ["h", "g"]).select("row", "cls"), "vector-members")
    one = classes.select(F.col("cls").alias("row"), "w", "least")
    full = source.select("row", "lab", "v", F.size("v").alias("dim")).join(one, "row")
    return members, materialize(full.withColumnRenamed("row", "cls"), "vectors")


def _found_links(vectors: DataFrame, threshold: float, window: int, recall: float, seed: int) -> DataFrame:
    """(u, v): forests of the links that the passes find, over all classes."""
    sizes = vectors.groupBy("lab", "dim").agg(F.count("*").alias("n"))
    largest = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    passes = passes_needed(largest, threshold, window, recall)
    label = vectors.schema["lab"].dataType.simpleString()
    keys = materialize(
        vectors.select("cls", "lab", "dim", "v").mapInArrow(
            _sign_keys(passes, seed), f"cls long, lab {label}, dim int, pass int, sign long"
        ),
        "vector-signs",
    )
    names = ["pass", "lab", "dim", "sign", "cls"]
    placed = number_rows(keys, [], [F.col(c) for c in names], "place", stored=True).select(
        "cls", "place", F.xxhash64("pass", "lab", "dim").alias("run")
    )
    own = F.floor((F.col("place") - 1) / BLOCK)
    early = (F.col("place") - 1) % BLOCK < window
    both = F.when(early & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = placed.withColumn("block", F.explode(both))
    rows = dealt.join(vectors.select("cls", "v"), "cls")
    return (
        rows.repartition("block").sortWithinPartitions("block", "place")
        .select("block", "place", "run", "cls", "v")
        .mapInArrow(_window_links(threshold, window), "u long, v long")
    )


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with equally long vectors, and those vectors at length 1."""
    for batch in batches:
        batch = batch.sort_by("dim")
        dims = batch.column("dim").to_numpy()
        cuts = np.flatnonzero(np.diff(dims, prepend=-1, append=-1))
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo), _rows(batch.column("v"), lo, hi)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with unit vectors in place of theirs."""
    for part, x in _by_length(batches):
        cuts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
        unit = pa.ListArray.from_arrays(cuts, pa.array(x.ravel()))
        names = ["cls", "component", "w", "dim"]
        yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [unit], names=[*names, "v"])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distance of each unit vector to the middle of its component."""
    for part, x in _by_length(batches):
        middle = part.column("middle").flatten().to_numpy().reshape(x.shape)
        names = ["cls", "component", "w"]
        yield pa.RecordBatch.from_arrays(
            [part.column(c) for c in names] + [pa.array(np.linalg.norm(x - middle, axis=1))],
            names=[*names, "far"],
        )


def _tile_counts(threshold: float):
    """Linked weight of the members of two tiles in each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                side = {}
                for s in ("a", "b"):
                    cls, w = (batch.column(f"{c}_{s}")[i].values.to_numpy() for c in ("cls", "w"))
                    x = batch.column(f"v_{s}")[i].values.flatten()
                    side[s] = cls, w, x.to_numpy().reshape(len(cls), -1)
                (cls_a, w_a, a), (cls_b, w_b, b) = side["a"], side["b"]
                linked = a @ b.T >= threshold
                cls, n = cls_a, linked @ w_b
                if batch.column("tile_a")[i].as_py() != batch.column("tile_b")[i].as_py():
                    cls, n = np.append(cls_a, cls_b), np.append(n, w_a @ linked)
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(n)], names=["cls", "n"])

    return run


def _count_links(vectors: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(cls, component, n): the weight linked to each class of a component, its own included."""
    members = materialize(
        vectors.join(groups.withColumnRenamed("node", "cls"), "cls")
        .select("cls", "component", "w", "dim", "v")
        .mapInArrow(_units, "cls long, component long, w long, dim int, v array<double>"),
        "vector-groups",
    )
    middle = (
        members.select("component", F.posexplode("v").alias("i", "x"))
        .groupBy("component", "i").agg(F.avg("x").alias("x"))
        .groupBy("component").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("m"))
        .select("component", F.transform("m", lambda s: s["x"]).alias("middle"))
    )
    # Written, so that the join knows its size.
    middle = materialize(middle, "vector-middles")
    far = materialize(
        members.join(middle, "component").mapInArrow(
            _distances, "cls long, component long, w long, far double"
        ),
        "vector-distances",
    )
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) - _DOUBT
    totals = materialize(
        far.groupBy("component").agg(F.max("far").alias("most"), F.sum("w").alias("total")),
        "vector-totals",
    )
    sure = totals.where(F.col("most") * 2 <= radius)
    tight = far.join(sure, "component").select("cls", "component", F.col("total").alias("n"))
    loose = far.join(totals.where(F.col("most") * 2 > radius).select("component"), "component")
    loose = materialize(loose, "vector-loose")
    if loose.isEmpty():
        return tight
    seated = number_rows(loose, ["component"], [F.col("far"), F.col("cls")], "seat")
    seated = materialize(
        seated.withColumn("tile", F.floor((F.col("seat") - 1) / TILE).cast("int")), "vector-seats"
    )
    edges = seated.groupBy("component", "tile").agg(
        F.min("far").alias("low"), F.max("far").alias("high"), F.sum("w").alias("weight")
    )
    edges = materialize(edges, "tile-edges")
    a, b = (
        edges.select("component", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "low", "high", "weight")])
        for s in ("a", "b")
    )
    # Distances that differ by more than the radius cannot belong to linked vectors.
    apart = F.greatest(F.col("low_b") - F.col("high_a"), F.col("low_a") - F.col("high_b"))
    near = a.join(b, "component").where(apart <= radius + 2 * _DOUBT)
    beyond_doubt = F.col("high_a") + F.col("high_b") <= radius
    certain = near.where(beyond_doubt).groupBy("component", F.col("tile_a").alias("tile")).agg(
        F.sum("weight_b").alias("n")
    )
    open_pairs = materialize(
        near.where(~beyond_doubt & (F.col("tile_a") <= F.col("tile_b")))
        .select("component", "tile_a", "tile_b"),
        "tile-pairs",
    )
    tiles = materialize(
        seated.join(members.select("cls", "v"), "cls").groupBy("component", "tile").agg(
            F.collect_list(F.struct("cls", "w", "v")).alias("rows")
        ).select("component", "tile", *[F.col(f"rows.{c}").alias(c) for c in ("cls", "w", "v")]),
        "vector-tiles", **{"parquet.block.size": 8 << 20},
    )
    for s in ("a", "b"):
        side = tiles.select(
            "component", F.col("tile").alias(f"tile_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "w", "v")]
        )
        open_pairs = open_pairs.join(side, ["component", f"tile_{s}"])
    measured = open_pairs.mapInArrow(_tile_counts(threshold), "cls long, n long")
    proven = seated.join(certain, ["component", "tile"]).select("cls", "n")
    counted = measured.unionByName(proven).groupBy("cls").agg(F.sum("n").alias("n"))
    return tight.unionByName(loose.select("cls", "component").join(counted, "cls").select("cls", "component", "n"))


def near_vectors(
    vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding",
    label: str = "label", window: int = WINDOW, recall: float = RECALL, seed: int = 11,
) -> DataFrame:
    """Adds to each row what it is linked with: ``n_links``, ``component_id`` and ``kept``.

    Two vectors may link if their labels are equal and not null, they have equally many components
    and their cosine, in double precision, is at least ``threshold`` (above 0). No link below it
    is ever made. Which links are sought is up to the sorted passes; at least a share
    of about ``recall`` of the pairs at the threshold meets, nearer ones oftener. ``n_links`` counts the other
    rows that a row links with inside its component, all of them, and ``component_id`` is the
    smallest key that links reach; ``kept`` says that it is the row's own.

    A vector that is null, empty or zero, or has a null, NaN or infinite component, or no label,
    links with nothing. Equal vectors of a label are linked, as are repeated rows, which stay rows of
    their own; a null key is larger than any other. Other columns stay; those with the name of a
    new one are replaced, in any case. No rows give no rows. ``vectors`` should come from files: a
    row's number must be the same whenever it is read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    named = lambda name: next(c for c in vectors.columns if c.lower() == name.lower())
    taken = {"n_links", "component_id", "kept", "_row"}
    kept = [c for c in vectors.columns if c.lower() not in taken]
    numbered = materialize(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{named(key)}`").cast("long").alias("vec"),
            F.col(f"`{named(label)}`").alias("lab"), F.col(f"`{named(vector)}`").alias("v"),
            F.struct(*[F.col(f"`{c}`") for c in kept if c != named(vector)]).alias("others"),
        ).withColumn("usable", F.col("lab").isNotNull() & usable(F.col("v"))),
        "vector-rows",
    )
    source = numbered.select("row", "vec", "lab", "v", "usable")
    members, classes = _classes(source)
    edges = materialize(_found_links(classes, threshold, window, recall, seed), "vector-edges")
    groups = connected(edges)
    counted = materialize(_count_links(classes, groups, threshold), "vector-links")
    narrow = classes.select("cls", "w", "least")
    roots = (
        counted.join(narrow, "cls").groupBy("component").agg(F.min("least").alias("root"))
    )
    grouped = counted.join(roots, "component").select("cls", "n", "root")
    alone = F.col("n").isNull()
    known = narrow.join(grouped, "cls", "left").select(
        "cls", F.coalesce("n", "w").alias("n"),
        F.when(alone, F.col("least")).otherwise(F.col("root")).alias("root"),
    )
    linked = members.join(known, "cls").select("row", (F.col("n") - 1).alias("n"), "root")
    linked = materialize(linked, "vector-result")
    joined = numbered.join(linked.withColumn("known", F.lit(True)), "row", "left")
    root = F.when(F.col("known"), F.col("root")).otherwise(F.col("vec"))
    return joined.select(
        *[F.col("v").alias(c) if c == named(vector) else F.col(f"others.`{c}`") for c in kept],
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
        F.col("vec").eqNullSafe(root).alias("kept"),
    )


def op13_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All embeddings, linked at a cosine of 0.93 within their label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return near_vectors(rows, 0.93).select("vec_id", "n_links", "component_id", "kept")


_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding, row_number() OVER () AS r FROM embeddings),
ok AS (
  SELECT vec_id, label, r, CAST(embedding AS DOUBLE[]) AS v FROM e
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
near AS (SELECT reach.a AS r, min(o.vec_id) AS least FROM reach JOIN e o ON o.r = reach.b GROUP BY reach.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(least, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(least, e.vec_id)) AS kept
FROM e LEFT JOIN near USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n FROM links GROUP BY a) c USING (r)
"""

QUERIES = {"op13_embedding_near_dedup": op13_embedding_near_dedup}
ORACLE = {"op13_embedding_near_dedup": _SQL}
