"""Ranked search against a plain implementation of its formulas."""

import math
import random
from collections import Counter

import pytest

from delaylab.llm import registered, search
from tests.llm.helpers import letters, table

WORDS = [a + b + c for a in "ba ce di fo".split() for b in "la me ni po".split() for c in ("", "s", "É")]


@pytest.fixture(scope="module", autouse=True)
def sent(spark):
    registered.send_package(spark)


def brute(docs, items, k=10):
    """(item, rank, doc, score) of (number, text) rows."""
    terms = [Counter(letters(text)) for _, text in docs]
    held = [t for t in terms if t]
    n_docs, n_terms = len(held), sum(sum(t.values()) for t in held)
    df = Counter(w for t in held for w in t)
    found = []
    for name, text in items:
        scored = []
        for (doc, _), own in zip(docs, terms):
            m = own and 10 + 90 * sum(own.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (10**9 * own[w] // (1000 * own[w] + 8 * m))
                for w in set(letters(text)) if own[w]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        found += [(name, i + 1, s[3], -s[0]) for i, s in enumerate(scored[:k])]
    return found


def odd_docs(rng):
    texts = [None, "", " .,; ", "Bala", "ÉÉ bala Bala BALA", "x" * 20_000, "bala " * 9000]
    texts += [" ".join(rng.choice(WORDS[: rng.randint(2, len(WORDS))]) for _ in range(rng.choice([5, 6, 40, 300])))
              for _ in range(160)]
    texts += [texts[-1]] * 60  # copies: ties, and a stratum that many documents share
    rows = list(enumerate(texts))
    return rows + [rows[12]] * 4 + [(None, texts[20])]


ITEMS = [(0, "bala cela"), (1, "Bala, BALA!"), (2, " ".join(WORDS)), (3, None), (4, "--"), (5, "nowhere"),
         (None, "foni dipo"), (2, "mela ÉÉ celas"), (7, "x" * 20_000)]


def rows_of(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, tmp_path, monkeypatch, small):
    """In one pass with large blocks, and in several passes over many small blocks."""
    options = {}
    if small:
        monkeypatch.setattr(search, "BLOCK_DOCS", 7)
        monkeypatch.setattr(search, "BLOCK_POSTINGS", 90)
        monkeypatch.setattr(search, "_WAITING", 20)
        monkeypatch.setattr(search, "_CELLS", 30)
        options["item_terms"] = 20
    docs = odd_docs(random.Random(5))
    one = table(spark, tmp_path, [(i, "z", t, i) for i, t in docs], "doc_id long, item string, Text string, rank int")
    two = table(spark, tmp_path, [(i, t, 1) for i, t in ITEMS], "item_id int, text string, doc_id int")
    found = search.search(one, two, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == sorted(brute(docs, ITEMS), key=str)
    assert rows_of(search.search(one, two, k=3)) == sorted(brute(docs, ITEMS, 3), key=str)


def test_search_with_nothing(spark, tmp_path):
    docs = table(spark, tmp_path, [(1, "bala"), (2, None)], "doc_id long, text string")
    items = table(spark, tmp_path, [(1, "bala"), (2, "")], "item_id long, text string")
    assert rows_of(search.search(docs, items)) == brute([(1, "bala"), (2, None)], [(1, "bala")])
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items)):
        assert search.search(a, b).collect() == []


def test_weak_blocks_are_passed_over(spark, tmp_path, monkeypatch):
    """Bounds spare most blocks the scoring, and the result stays whole."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 5)
    docs = [(i, "common " * (i % 50 + 1) + ("rare thing" if i % 97 == 0 else "")) for i in range(1000)]
    items = [(0, "rare thing common")]
    found = search.search(
        table(spark, tmp_path, docs, "doc_id long, text string"),
        table(spark, tmp_path, items, "item_id long, text string"), k=5,
    )
    assert rows_of(found) == sorted(brute(docs, items, 5), key=str)
