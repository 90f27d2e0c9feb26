"""Near-duplicate vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from delaylab.llm import registered, vectors
from tests.llm.helpers import components, table

SCHEMA = "vec_id long, label string, Embedding array<double>, Kept int, `a.b` string"


@pytest.fixture(scope="module", autouse=True)
def sent(spark):
    registered.send_package(spark)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold):
    """{row number: (n_links, component)}; keys of ``rows`` are (vec_id, label, vector)."""
    unit = {}
    for i, (_, label, v) in enumerate(rows):
        if label is not None and usable(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    links = [
        (i, j) for i in unit for j in unit
        if i < j and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold
    ]
    group = components(range(len(rows)), links)
    least = {}
    for i, root in group.items():
        if rows[i][0] is not None:
            least[root] = min(least.get(root, rows[i][0]), rows[i][0])
    degree = {i: 0 for i in range(len(rows))}
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    return {i: (degree[i], least.get(group[i])) for i in degree}


def check(spark, tmp_path, rows, threshold, **options):
    given = [(v, lab, x, i, "k") for i, (v, lab, x) in enumerate(rows)]
    df = table(spark, tmp_path, given, SCHEMA.replace("Kept", "place"))
    found = vectors.near_vectors(df, threshold, vector="embedding", **options)
    assert found.columns == ["vec_id", "label", "Embedding", "place", "a.b", "n_links", "component_id", "kept"]
    got = {r.place: r for r in found.collect()}
    assert len(got) == len(rows)
    expected = brute(rows, threshold)
    for i, (vec, _, x) in enumerate(rows):
        assert (got[i].n_links, got[i].component_id) == expected[i], i
        assert got[i].kept == (vec == expected[i][1])
    return got


def cloud(rng, n, dim, spread, centre=None):
    centre = rng.standard_normal(dim) if centre is None else centre
    centre = centre / np.linalg.norm(centre)
    return [(centre + spread * rng.standard_normal(dim) / math.sqrt(dim)).tolist() for _ in range(n)]


def odd_rows():
    rng = np.random.default_rng(2)
    rows = [(None, "x"), ([], "x"), ([0.0, 0.0], "x"), ([1.0, None], "x"), ([float("nan"), 1.0], "x"),
            ([float("inf"), 1.0], "x"), ([1.0, 0.0], None), ([1.0, 0.0], "x"), ([2.0, 0.0], "x"),
            ([1e300, 1e-300], "x"), ([1e-300, 0.0], "x"), ([1.0, 0.0], "y"), ([1.0, 0.0, 0.0], "x"),
            ([-1.0, 0.0], "x"), ([1.0, 0.0], "x"), ([1.0, 0.0], "x")]
    rows = [(i, lab, v) for i, (v, lab) in enumerate(rows)]
    rows += [(None, "x", [1.0, 0.01]), (7, "x", [1.0, 0.0]), (None, "z", [1.0, 1.0]), (None, None, [1.0, 1.0])]
    for n, spread in ((40, 0.05), (30, 0.25), (25, 0.4), (1, 0.1)):
        rows += [(100 + len(rows) + i, "c", v) for i, v in enumerate(cloud(rng, n, 16, spread))]
    rows += [(900 + i, "h", [0.5, 0.25, 0.125]) for i in range(200)]  # a hot vector
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [256, 6])
def test_links_equal_brute_force(spark, tmp_path, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    check(spark, tmp_path, odd_rows(), 0.93)


def test_chains_and_loose_groups(spark, tmp_path, monkeypatch):
    """A chain is one component in which few are linked directly."""
    monkeypatch.setattr(vectors, "TILE", 8)
    chain = [(i, "a", [math.cos(i / 9), math.sin(i / 9)]) for i in range(50)]
    got = check(spark, tmp_path, chain, 0.93)
    assert {r.component_id for r in got.values()} == {0} and max(r.n_links for r in got.values()) < 8


def test_recall_over_many_blocks(spark, tmp_path, monkeypatch):
    """Pairs just above the threshold among thousands of strangers, in windows far smaller than a label."""
    monkeypatch.setattr(vectors, "BLOCK", 100)
    rng = np.random.default_rng(3)
    rows, dim = [], 24
    for i in range(150):
        a = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(dim)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cos = rng.uniform(0.931, 0.95)
        rows += [(2 * i, "p", a.tolist()), (2 * i + 1, "p", (cos * a + math.sqrt(1 - cos**2) * b).tolist())]
    rows += [(1000 + i, "p", rng.standard_normal(dim).tolist()) for i in range(3000)]
    rows += [(9000 + i, "p", v) for i, v in enumerate(cloud(rng, 400, dim, 0.2))]
    df = table(spark, tmp_path, [(*r, 0, "") for r in rows], SCHEMA)
    got = {r.vec_id: r for r in vectors.near_vectors(df, 0.93, window=16).select("vec_id", "n_links", "component_id").collect()}
    expected = brute(rows, 0.93)
    links = sum(n for n, _ in expected.values())
    assert all(got[rows[i][0]].n_links <= n for i, (n, _) in expected.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * links
    pairs = [got[2 * i].component_id == got[2 * i + 1].component_id for i in range(150)]
    assert sum(pairs) >= 0.97 * len(pairs)


def test_nothing_and_arguments(spark, tmp_path):
    df = table(spark, tmp_path, [(1, "x", [1.0], 0, "")], SCHEMA)
    assert vectors.near_vectors(df.limit(0), 0.9).count() == 0
    row = vectors.near_vectors(df, 0.9).collect()[0]
    assert (row.n_links, row.component_id, row.kept) == (0, 1, True)
    with pytest.raises(ValueError):
        vectors.near_vectors(df, 0.0)


def test_passes_follow_the_rows():
    needed = [vectors.passes_needed(n, 0.93) for n in (0, 64, 1000, 10**5, 10**9)]
    assert needed == sorted(needed) and needed[-1] < 200
    assert vectors.passes_needed(1000, 0.99) < vectors.passes_needed(1000, 0.9)
