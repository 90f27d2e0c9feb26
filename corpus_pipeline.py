"""A training corpus from raw documents: language, repeated passages, near copies, benchmark, packing."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaylab.llm import (
    decontamination, language, linededup, neardup, packing, registered, scratch,
)
from delaylab.session import new_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, judged with what the pages teach about languages and hosts.

    Null, empty and very short texts are in no known language and go. Of equally likely languages
    the first by name counts. Repeated rows are judged alike; no documents give none.
    """
    pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet"))
    return language.keep_identified(docs, pages)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without multi-line passages that stand in an earlier one.

    Null and empty texts stay as they are. Of repeated rows and passages the first in the order
    of the rows keeps them; a document that loses everything goes. No documents give none.
    """
    return linededup.without_repeats(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    The smallest number of a group stays, the first row of equal numbers; a null number is larger
    than any other. Documents without words are copies of nothing and stay. No documents give none.
    """
    return neardup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no ten words of a benchmark item; shorter items drop nothing.

    Null and empty texts repeat nothing and stay, repeated rows are judged alike, and no documents
    give none.
    """
    items = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontamination.drop_contaminated(docs, items)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, with the ids, in sequences of at most 2048.

    A null text is packed as an empty one, by its end id alone. Every row is packed, repeated
    ones too; no documents give no pieces.
    """
    return packing.packed_documents(docs)


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """``function``, without the intermediate tables of the stage before it.

    ``docs`` has been written and read again by then, so nothing reads those tables any more.
    """

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        owner = f"pipeline over {sf_dir}"
        scratch.released(spark, owner)
        scratch.small_batches(spark)
        with scratch.owned(owner):
            return function(spark, docs, sf_dir)

    return stage


STAGES = [
    ("language_id", _stage(language_id)),
    ("line_dedup", _stage(line_dedup)),
    ("ngram_jaccard_join", _stage(ngram_jaccard_join)),
    ("benchmark_decontamination", _stage(benchmark_decontamination)),
    ("packing", _stage(pack)),
]

#: Language models, near copies over whole texts and token ids have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written and read again before the next one."""
    registered.send_package(spark)
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = new_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
