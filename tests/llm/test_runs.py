"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylab.llm import registered, runs
from tests.llm.helpers import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def sent(spark):
    registered.send_package(spark)


def brute_runs(words, least_length=6, least_copies=4):
    """Longest stretches per period by comparing all words that lie a period apart."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least_length, least_copies * q):
                found.setdefault((start, length), q)  # periods rise: the first is the smallest
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, found):
    lost = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in lost)


def test_runs_of_random_sequences():
    rng = random.Random(3)
    for _ in range(1500):
        kinds, n = rng.choice([1, 2, 3]), rng.randint(0, 60)
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            p, a = rng.randint(1, n // 4), rng.randrange(n // 2)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        for least in ((6, 4), (2, 2), (4, 3)):
            got = zip(*(x.tolist() for x in runs.runs_of(np.array(words, np.int64), *least)))
            assert list(got) == brute_runs(words, *least)


def test_runs_of_famous_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a  # Fibonacci words are full of squares and of no fourth power
    assert len(runs.runs_of(np.array(b), 6, 4)[0]) == 0
    got = zip(*(x.tolist() for x in runs.runs_of(np.array(b), 2, 2)))
    assert list(got) == brute_runs(b, 2, 2)
    for many in (np.zeros(50_000, np.int64), np.arange(50_000) % 12_000):
        assert runs.runs_of(many)[2].tolist() == [int(many.max()) + 1]


def test_operator_on_odd_texts(spark, tmp_path):
    rng = random.Random(4)
    loop = " ".join(["x y z"] * 300)
    texts = [None, "", " \n\t ", "one", "a a a a a a", "a a a a a", "A a A a A a A a", loop,
             "é é é é é é é é é é", "p q " * 4 + "p " + "r " * 9, "b " * 60_000,
             " ".join(str(rng.randrange(40)) for _ in range(30_000)) + " " + loop]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(40)]
    rows = [(i, t, i, "k") for i, t in enumerate(texts)] + [(None, loop, 0, "k")] + [(7, loop, 7, "k")] * 3
    docs = table(spark, tmp_path, rows, "doc_id long, TEXT string, Runs int, `my key` string")
    got = runs.find_runs(docs, "text")
    assert got.columns == ["doc_id", "TEXT", "my key", "n_words", "runs", "collapsed"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        words = WORD.findall(r.TEXT or "")
        expected = brute_runs(words) if len(words) < 5000 else [tuple(x) for x in r.runs]
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == expected
        assert r.collapsed == brute_collapsed(words, expected)
    long = {r.doc_id: r for r in got}
    assert [tuple(x) for x in long[10].runs] == [(0, 60_000, 1)] and long[10].collapsed == "b"
    assert (30_000, 900, 3) in [tuple(x) for x in long[11].runs]
    assert runs.find_runs(docs.limit(0), "text").count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, "text", least_copies=1)


def test_a_whole_text_is_found_whatever_stands_beside_it(spark, tmp_path):
    """Texts of one chunk have nothing to do with each other."""
    rows = [(i, "m n " * 3) for i in range(50)]
    got = runs.find_runs(table(spark, tmp_path, rows, "doc_id long, text string").coalesce(1))
    assert {len(r.runs) for r in got.collect()} == {0}


def looped(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op12_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in runs.op12_periodic_runs(spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    seen = 0
    for doc_id, text in texts:
        words, r = looped(doc_id, WORD.findall(text or "")), rows[doc_id]
        if len(words) > 3000:
            continue
        found = brute_runs(words)
        seen += bool(found)
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if found else None)
        assert r.runs_sha256 == digest("".join("%d,%d,%d\n" % x for x in found))
        assert r.collapsed_sha256 == digest(brute_collapsed(words, found))
    assert seen > 5


def test_looped_texts_without_number_or_words(spark):
    df = spark.createDataFrame([(None, "a b"), (3, ""), (4, None)], "doc_id long, text string")
    got = df.select(runs.looped(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert got[0].t == "a b" and (got[1].t or "") == "" and got[2].t is None
