"""The pipeline stage by stage, as a whole, and on odd tables."""

import zlib

import pytest

import corpus_pipeline
from delaylab.llm import registered
from tests.llm.helpers import shingles

#: What a piece is, apart from the sequence it was dealt to.
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def staged(spark, docs, sf_dir, folder):
    """The tables that the stages write, one after the other."""
    tables = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / f"{n}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append((name, docs))
    return tables


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    registered.send_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, staged(spark, docs, sf_dir, tmp_path_factory.mktemp("stages"))


def test_stages_keep_columns_and_act(stages):
    first, tables = stages
    counts = [first.count()]
    for n, (name, docs) in enumerate(tables):
        if n < 4:
            assert docs.columns == first.columns
            counts.append(docs.count())
        if name == "ngram_jaccard_join":
            sets = {r.doc_id: shingles(r.text, 5) for r in docs.collect()}
            ids = sorted(sets)
            assert not any(
                100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
                for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b]
            )
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] >= counts[4] > 0.5 * counts[0]
    packed = tables[-1][1].collect()
    tokens, length = {}, {}
    for p in packed:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
        tokens[p.doc_id] = p.doc_tokens
        length[p.doc_id] = length.get(p.doc_id, 0) + p.length
    assert tokens == length and len(tokens) == counts[4]


def test_run_equals_its_stages(spark, sf_dir, stages):
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == stages[1][-1][1].columns
    assert sorted(map(tuple, whole.select(*PIECE).collect())) == sorted(
        map(tuple, stages[1][-1][1].select(*PIECE).collect())
    )


NAMES = "doc_id long, text string, lang string, source string, row string, doc int, class int, lost int, key string, host int"


def test_stages_on_odd_tables(spark, sf_dir, tmp_path):
    """Nulls, empty and repeated texts, columns named as those inside the stages, and no rows."""
    clean = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in clean]
    rows += [(None, None, None, None), (1001, "", "en", None), (1002, " \n ", None, "src1"), (None, rows[0][1], None, None)]
    rows += rows[:4] + [(1003, "word " * 20_000, "xx", "src2")]
    given = [(*r, "own", 1, 2, 3, "k", 4) for r in rows]
    path = str(tmp_path / "odd")
    spark.createDataFrame(given, NAMES).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    tables = staged(spark, docs, sf_dir, tmp_path / "full")
    assert all(t.columns == docs.columns for _, t in tables[:4])
    assert {r["row"] for r in tables[3][1].collect()} == {"own"}
    numbers = [r.doc_id for r in tables[3][1].collect()]
    assert len(numbers) == len(set(numbers)) > 10
    none = staged(spark, docs.limit(0), sf_dir, tmp_path / "none")
    assert all(t.count() == 0 for _, t in none)
